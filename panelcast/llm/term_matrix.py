"""Words of texts as sparse document-term matrices, built on Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from panelcast.llm.words import SPACE, utf8, word_hashes

WORD_BYTES = ~SPACE


def packed(column: pa.Array, inside: np.ndarray = WORD_BYTES, fold: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """All longest runs of ``inside`` bytes as one string array, and how many precede each text.

    ``fold`` maps bytes to bytes, for instance to lower case. Null texts have no runs. Neither table
    may tell the bytes of one UTF-8 character apart.
    """
    data, offsets = utf8(column)
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(offsets), np.int64)
    held = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = held.copy(), held.copy()
    first[1:] &= ~held[:-1] | edge[1:-1]
    last[:-1] &= ~held[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    # where each run begins once the bytes between runs are gone
    at = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - starts)])
    flat = data[held]
    if fold is not None:
        flat = fold[flat]
    runs = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(flat)))
    return runs, np.searchsorted(starts, offsets)


def compressed_rows(numbers: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indptr, indices, counts) of the rows whose numbers lie between ``before[i]`` and ``before[i + 1]``."""
    n = len(before) - 1
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(before))
    cells, counts = np.unique(row * max(width, 1) + numbers, return_counts=True)
    indptr = np.searchsorted(cells, np.arange(n + 1, dtype=np.int64) * max(width, 1))
    return indptr, cells % max(width, 1), counts


def encoded(runs: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of each string in a dictionary of the distinct ones, in order of appearance."""
    if not len(runs):
        return np.zeros(0, np.int64), runs
    held = runs.dictionary_encode()
    return held.indices.to_numpy().astype(np.int64), held.dictionary


def string_hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string."""
    data, at = utf8(strings)
    return word_hashes(data, at[:-1], at[1:])
