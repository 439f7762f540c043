"""Windows of words that repeat across documents, found by super-k-mers.

Every window of ``window`` words has a minimiser: the least hash of the runs of ``core`` words in it.
Consecutive windows with one minimiser form a super-k-mer, which travels as one packed string to the
bucket of that minimiser. Equal windows have equal minimisers, so each bucket decides its windows by
itself, by sorting them.

A minimiser that only one document has cannot be that of a repeated window. So the minimisers are
counted first, as numbers, and only super-k-mers whose minimiser is shared are packed.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.words import mix, slices, utf8, word_bounds, word_hashes
from panelcast.runtime import cut_lineage


@dataclass(frozen=True)
class Repeats:
    window: int = 50
    core: int = 12  # words of a minimiser
    bucket_rows: int = 8192  # larger buckets are decided window by window instead
    sort_words: int = 1 << 20  # about as many words are sorted at a time


def window_minima(hashes: np.ndarray, window: int, core: int) -> np.ndarray:
    """The minimiser of the window at each word, where a window fits."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    step = np.uint64(0xD6E8FEB86659FD93)
    cores = hashes[: len(hashes) - core + 1].copy()
    for k in range(1, core):
        cores = cores * step + hashes[k : len(hashes) - core + 1 + k]
    least, span, want = mix(cores), 1, window - core + 1
    while span < want:
        shift = min(span, want - span)
        least = np.minimum(least[:-shift], least[shift:])
        span += shift
    return least


def super_kmers(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """(doc_id, hash, mini, start, windows): runs of windows with one minimiser, as numbers.

    ``docs``: (doc_id, hash, text). Texts with fewer words than a window have none.
    """

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column(2))
            for low, high in slices(at):
                yield _runs(batch.slice(low, high - low), data[at[low] : at[high]], at[low : high + 1] - at[low], how)

    return docs.mapInArrow(run, "doc_id long, hash long, mini long, start int, windows int")


def _runs(batch: pa.RecordBatch, data: np.ndarray, at: np.ndarray, how: Repeats) -> pa.RecordBatch:
    starts, ends, before = word_bounds(data, at)
    least = window_minima(word_hashes(data, starts, ends), how.window, how.core)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(before))
    first = np.flatnonzero(owner[: len(least)] == owner[how.window - 1 :]) if len(least) else np.zeros(0, np.int64)
    new = np.ones(len(first), bool)
    new[1:] = (np.diff(first) > 1) | (least[first[1:]] != least[first[:-1]]) | (owner[first[1:]] != owner[first[:-1]])
    begin = np.flatnonzero(new)
    at_word, text = first[begin], owner[first[begin]]
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(pa.array(text)),
            batch.column(1).take(pa.array(text)),
            pa.array(least[at_word].view(np.int64)),
            pa.array((at_word - before[text]).astype(np.int32)),
            pa.array(np.diff(np.append(begin, len(first))).astype(np.int32)),
        ],
        ["doc_id", "hash", "mini", "start", "windows"],
    )


def packed(docs: DataFrame, kmers: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """(mini, doc_id, hash, start, large, words): a packed string for each row of ``kmers``.

    Rows of a large bucket are spread as single windows instead, each with its SHA-256 as ``words``.
    """
    runs = kmers.groupBy("doc_id", "hash").agg(F.collect_set(F.struct("start", "windows", "mini", "large")).alias("runs"))
    held = docs.join(runs, ["doc_id", "hash"]).select("doc_id", "hash", "text", "runs")
    schema = "mini long, doc_id long, hash long, start int, large boolean, words binary"
    arrow = pa.schema(
        [("mini", pa.int64()), ("doc_id", pa.int64()), ("hash", pa.int64()), ("start", pa.int32()), ("large", pa.bool_()), ("words", pa.binary())]
    )

    def run(batches):
        for batch in batches:
            out, size = [], 0
            for i in range(batch.num_rows):
                doc_id, key, text, found = (batch.column(c)[i].as_py() for c in range(4))
                words = text.encode().split()
                for r in found:
                    begin, n = r["start"], r["windows"]
                    if r["large"]:
                        for s in range(begin, begin + n):
                            digest = hashlib.sha256(b" ".join(words[s : s + how.window])).digest()
                            out.append((r["mini"], doc_id, key, s, True, digest))
                        size += 64 * n
                    else:
                        together = b" ".join(words[begin : begin + n + how.window - 1])
                        out.append((r["mini"], doc_id, key, begin, False, together))
                        size += len(together) + 64
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return held.mapInArrow(run, schema)


def window_ranks(ids: np.ndarray, window: int) -> np.ndarray:
    """Equal numbers for equal windows of ``ids``: ranks of runs of 1, 2, 4, … words, by sorting."""
    rank, span = ids, 1
    while span < window:
        shift = min(span, window - span)
        pair = rank[:-shift] * (int(rank.max()) + 1) + rank[shift:]
        rank, span = np.unique(pair, return_inverse=True)[1], span + shift
    return rank


def repeated_in_buckets(packs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """(doc_id, hash, low, high): words [low, high) that windows of an earlier document cover."""

    def run(batches):
        held, words = [], 0
        for batch in batches:
            held.append(batch)
            words += batch.num_rows * how.window
            if words < how.sort_words:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            mini = rows.column(0).to_numpy()
            change = np.flatnonzero(mini[1:] != mini[:-1])
            if len(change):
                cut = int(change[-1]) + 1
                yield _covered(rows.slice(0, cut), how)
                rows = rows.slice(cut)
            held, words = [rows], rows.num_rows * how.window
        if held:
            yield _covered(pa.Table.from_batches(held).combine_chunks().to_batches()[0], how)

    dealt = packs.select("mini", "doc_id", "hash", "start", "words").repartition("mini").sortWithinPartitions("mini")
    return dealt.mapInArrow(run, "doc_id long, hash long, low int, high int")


def _covered(rows: pa.RecordBatch, how: Repeats) -> pa.RecordBatch:
    doc, start = rows.column(1).to_numpy(), rows.column(3).to_numpy()
    number: dict[bytes, int] = {}
    ids, lengths = [], []
    for text in rows.column(4):
        words = text.as_py().split(b" ")
        ids.append(np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, len(words)))
        lengths.append(len(words))
    lengths = np.array(lengths)
    rank = window_ranks(np.concatenate(ids), how.window)
    row = np.repeat(np.arange(len(lengths)), lengths - how.window + 1)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(lengths - how.window + 1) - (lengths - how.window + 1), lengths - how.window + 1)
    rank = rank[np.repeat(np.cumsum(lengths) - lengths, lengths - how.window + 1) + offset]
    order = np.lexsort((doc[row], rank))
    head = np.ones(len(order), bool)
    head[1:] = rank[order][1:] != rank[order][:-1]
    earliest = doc[row][order][np.flatnonzero(head)][np.cumsum(head) - 1]
    hit = np.zeros(len(order), bool)
    hit[order] = doc[row][order] > earliest
    at = np.flatnonzero(hit)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (row[at[1:]] != row[at[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    of = pa.array(row[at[first]])
    low = start[row[at[first]]] + offset[at[first]]
    high = start[row[at[first]]] + offset[at[last]] + how.window if len(at) else low
    return pa.RecordBatch.from_arrays(
        [rows.column(1).take(of), rows.column(2).take(of), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
        ["doc_id", "hash", "low", "high"],
    )


def repeated_spans(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """(doc_id, hash, low, high) of all words of ``docs`` (doc_id, hash, text) to remove."""
    kmers = cut_lineage(super_kmers(docs.where("doc_id IS NOT NULL AND text IS NOT NULL"), how))
    counts = kmers.groupBy("mini").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    shared = counts.where("low < high").select("mini", (F.col("n") > how.bucket_rows).alias("large"))
    packs = cut_lineage(packed(docs, kmers.join(shared, "mini"), how))
    small = repeated_in_buckets(packs.where("NOT large"), how)
    large = packs.where("large").select("doc_id", "hash", "start", "words")
    first = large.groupBy("words").agg(F.min("doc_id").alias("first"))
    late = large.join(first, "words").where("doc_id > first")
    return small.unionByName(
        late.select("doc_id", "hash", F.col("start").alias("low"), (F.col("start") + how.window).alias("high"))
    )


def without_repeats(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """(doc_id, kept, n_words, n_removed) of each row of ``docs`` (doc_id, text, …).

    A word goes if a window over it also starts in a document with a smaller doc_id. ``kept`` joins
    the other words by single spaces (null and empty texts: no words, ''). Windows within one
    document, or in rows with the same doc_id, do not remove each other. A row without doc_id keeps
    its words and removes none. Several rows may share a doc_id; each is judged by itself.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("hash"), "text")
    spans = repeated_spans(own, how).groupBy("doc_id", "hash").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    held = own.join(spans, ["doc_id", "hash"], "left").select("doc_id", "text", "spans")

    def run(batches):
        for batch in batches:
            kept, words_of, removed = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                words_of.append(len(words))
                if spans.is_valid:
                    keep = np.ones(len(words), bool)
                    for s in spans.as_py():
                        keep[s["low"] : s["high"]] = False
                    words = [words[i] for i in np.flatnonzero(keep)]
                kept.append(b" ".join(words).decode())
                removed.append(words_of[-1] - len(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.string()), pa.array(words_of, pa.int64()), pa.array(removed, pa.int64())],
                ["doc_id", "kept", "n_words", "n_removed"],
            )

    return held.mapInArrow(run, "doc_id long, kept string, n_words long, n_removed long")
