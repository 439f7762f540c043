"""Benchmark decontamination by latent semantic retrieval.

Passages of the benchmark, weighted by TF-IDF with document frequencies of all documents, are cut
into blocks. Each block gets a latent space of its own from a randomised SVD, so that the rank keeps
up with a growing benchmark. Windows of the documents are folded in and compared by cosine;
candidates are checked by longest common subsequence and by the item's last words. Items of a few
words, too short for that, are looked up whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.words import mix, slices, utf8, word_bounds, word_hashes
from panelcast.runtime import cut_lineage

# letters, digits and bytes of other characters make words; A-Z are lower-cased
_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58], _FOLD[97:123], _FOLD[65:91] = np.arange(48, 58), np.arange(97, 123), np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class LatentParams:
    windows: tuple[int, ...] = (16, 32)  # words of a passage: of short items, of others
    short: int = 24  # items with fewer words are short
    exact: int = 8  # items with fewer words say too little for a cosine: all their words must follow each other
    exact_block: int = 1 << 14  # such items that are searched together
    buckets: int = 1 << 16  # document frequencies are kept per hash bucket
    block: int = 512  # passages that share a latent space
    rank: int = 384
    rounds: int = 8  # blocks compared in one pass over the documents
    cosine: float = 0.35  # least cosine of a candidate, relative to an exact copy's
    overlap: float = 0.7  # least share of the item's words, in order
    verbatim: float = 0.9  # from this share on the answer needs no check
    answer_share: float = 0.25  # last part of an item that counts as its answer
    answer: float = 0.6  # least share of the answer's words, in order
    seed: int = 13


def folded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and begins of texts: lower-cased, with a space for all that makes no words."""
    data, at = utf8(column)
    out = _FOLD[data]
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][capital] += 0x20
    return out, at


def hashed(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and how many words precede each text."""
    starts, ends, before = word_bounds(data, at)
    return word_hashes(data, starts, ends), before


def document_frequencies(docs: DataFrame, buckets: int) -> tuple[int, np.ndarray]:
    """How many documents there are, and how many have a word of each bucket.

    Tasks send sums per bucket, so what moves is bounded by tasks × buckets and what is returned by
    the buckets.
    """

    def run(batches):
        total, texts = np.zeros(buckets, np.int64), 0
        for batch in batches:
            data, at = folded(batch.column(0))
            texts += batch.num_rows
            for low, high in slices(at):
                words, before = hashed(data[at[low] : at[high]], at[low : high + 1] - at[low])
                text = np.repeat(np.arange(high - low), np.diff(before))
                seen = np.unique(text * buckets + (words % np.uint64(buckets)).astype(np.int64))
                total += np.bincount(seen % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], texts))], ["bucket", "n"])

    counted = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets + 1, np.int64)
    out[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return int(out[-1]), out[:-1]


def passages(items: DataFrame, params: LatentParams) -> DataFrame:
    """(key, item_id, part, kind, words, whole): windows of the words of each item, as hashes.

    Items are told apart by id and text (``key``), so null and repeated ids are items too; equal rows
    are one. Windows of an item are a quarter of a window apart, those of a document half a window,
    or a quarter if short, so that they meet at most an eighth of a window out of step. The first
    window carries the words of the whole item. Items of fewer than ``exact`` words have one window
    and the kind EXACT; items without words have none.
    """

    def run(batches):
        for batch in batches:
            rows = []
            hashes, before = hashed(*folded(batch.column(2)))
            for i, (key, item) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                words = hashes[before[i] : before[i + 1]].view(np.int64)
                if not len(words):
                    continue
                kind = EXACT if len(words) < params.exact else int(len(words) >= params.short)
                window = len(words) if kind == EXACT else params.windows[kind]
                last = max(len(words) - window, 0)
                for n, s in enumerate(sorted({*range(0, last, max(window // 4, 1)), last})):
                    part = words[s : s + window]
                    rows.append({"key": key, "item_id": item, "part": n, "kind": kind, "words": part, "whole": None if n else words})
            yield pa.RecordBatch.from_pylist(rows, _PASSAGE)

    told = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    return told.select(F.xxhash64("item_id", "text").alias("key"), "item_id", "text").mapInArrow(run, _PASSAGE_SQL)


EXACT = 2  # kind of the shortest items; the kinds 0 and 1 number ``windows``
_PASSAGE_SQL = "key long, item_id long, part int, kind int, words array<long>, whole array<long>"
_PASSAGE = pa.schema(
    [("key", pa.int64()), ("item_id", pa.int64()), ("part", pa.int32()), ("kind", pa.int32()), ("words", pa.list_(pa.int64())), ("whole", pa.list_(pa.int64()))]
)


def randomised_svd(a: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """The leading right singular vectors of ``a``, features × rank, by random range finding."""
    rng = np.random.default_rng(seed)
    size = min(rank + 10, *a.shape)
    q = np.linalg.qr(a @ rng.normal(size=(a.shape[1], size)).astype(a.dtype))[0]
    for _ in range(2):
        q = np.linalg.qr(a @ np.linalg.qr(a.T @ q)[0])[0]
    _, s, v = np.linalg.svd(q.T @ a, full_matrices=False)
    keep = min(rank, int((s > s[0] * 1e-5).sum()) if len(s) and s[0] > 0 else 0)
    return v[:keep].T


def weighted(words: np.ndarray, idf: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns and weights √tf · idf of the words that the vocabulary has."""
    kept, counts = np.unique(words, return_counts=True)
    at = np.minimum(np.searchsorted(vocabulary, kept), len(vocabulary) - 1)
    known = vocabulary[at] == kept
    return at[known], np.sqrt(counts[known]) * idf[(kept[known] % np.uint64(len(idf))).astype(np.int64)]


def latent_blocks(items: DataFrame, idf: np.ndarray, params: LatentParams) -> DataFrame:
    """The latent space of each block of passages as arrays (block, name, shape, data), one task per block.

    Items are spread by hash over enough blocks that each has about ``block`` passages, however many
    items there are; all passages of an item are in one block. Blocks of EXACT items have no space.
    """
    rows = cut_lineage(passages(items, params))
    sizes = {r["exact"]: r["n"] for r in rows.groupBy((F.col("kind") == EXACT).alias("exact")).agg(F.count("*").alias("n")).collect()}
    latent, exact = (max(1, -(-sizes.get(k, 0) // n)) for k, n in ((False, params.block), (True, params.exact_block)))

    def run(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(["key", "part"], kind="stable")
        firsts = held[held["part"] == 0]
        texts = [np.asarray(w, np.int64) for w in firsts["whole"]]
        parts = {
            "keys": firsts["key"].to_numpy(np.int64),
            "ids": np.array([int(k or 0) for k in firsts["item_id"]], np.int64),
            "named": firsts["item_id"].notna().to_numpy(np.int64),
            "texts": np.concatenate(texts),
            "lengths": np.array([len(t) for t in texts], np.int64),
        }
        if held["kind"].iloc[0] != EXACT:
            words = [np.asarray(w, np.int64).view(np.uint64) for w in held["words"]]
            vocabulary = np.unique(np.concatenate(words))
            a = np.zeros((len(words), len(vocabulary)), np.float32)
            for i, w in enumerate(words):
                at, weight = weighted(w, idf, vocabulary)
                a[i, at] = weight
            v = randomised_svd(a, params.rank, params.seed).astype(np.float32)
            latent = a @ v
            size = np.linalg.norm(latent, axis=1)
            parts |= {
                "vocabulary": vocabulary,
                "v": v,
                "latent": latent / np.maximum(size, 1e-9)[:, None],
                "own": (size / np.maximum(np.linalg.norm(a, axis=1), 1e-9)).astype(np.float32),
                "item": held["key"].to_numpy(np.int64),
                "window": np.array([params.windows[held["kind"].iloc[0]]], np.int64),
            }
        out = pd.DataFrame({"name": list(parts)})
        out["shape"] = [list(x.shape) for x in parts.values()]
        out["data"] = [x.tobytes() for x in parts.values()]
        return out.assign(block=held["block"].iloc[0])[["block", "name", "shape", "data"]]

    number = F.pmod(F.xxhash64("key"), F.when(F.col("kind") == EXACT, exact).otherwise(latent))
    spread = rows.withColumn("block", number * 3 + F.col("kind"))
    # ids as objects: null must not turn the others into doubles
    spread = spread.withColumn("item_id", F.col("item_id").cast("string"))
    return spread.groupBy("block").applyInPandas(run, "block long, name string, shape array<long>, data binary")


_ROUNDING = 0.999  # slack of the bounds
_KINDS = {"vocabulary": np.uint64, **dict.fromkeys(("item", "keys", "ids", "named", "texts", "lengths", "window"), np.int64)}


def collected(blocks: DataFrame) -> list[dict]:
    """The arrays of a few blocks, with the words and ids of their items by key."""
    out: dict[int, dict] = {}
    for r in blocks.collect():
        array = np.frombuffer(r["data"], _KINDS.get(r["name"], np.float32)).reshape(r["shape"])
        out.setdefault(r["block"], {})[r["name"]] = array
    for b in out.values():
        keys = b["keys"].tolist()
        b["ids"] = {k: i if named else None for k, i, named in zip(keys, b["ids"].tolist(), b["named"].tolist())}
        b["texts"] = dict(zip(keys, np.split(b["texts"], np.cumsum(b["lengths"])[:-1])))
        if "window" in b:
            b["window"] = int(b["window"][0])
        else:
            b["sequences"] = sequences(b["texts"])
    return [out[k] for k in sorted(out)]


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each place on."""
    h = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for k in range(n):
        h = mix(h + words[k : k + len(h)])
    return h


def sequences(texts: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, dict[tuple, list[int]]]]:
    """By number of words: sorted hashes of the items' words, and the keys of the items with given words."""
    held: dict[int, dict[tuple, list[int]]] = {}
    for key, words in texts.items():
        held.setdefault(len(words), {}).setdefault(tuple(words.tolist()), []).append(key)
    return {
        n: (np.unique([sequence_hashes(np.array(w, np.int64).view(np.uint64), n)[0] for w in items]), items)
        for n, items in held.items()
    }


def whole_items(words: np.ndarray, before: np.ndarray, block: dict):
    """(text, key) of the items of an EXACT block whose words all follow each other in a text, once each."""
    for n, (hashes, items) in block["sequences"].items():
        h = sequence_hashes(words, n)
        at = np.flatnonzero(hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h)
        text = np.searchsorted(before, at, side="right") - 1
        inside = at + n <= before[text + 1]
        at, text = at[inside], text[inside]
        if not len(at):
            continue
        # once per text and sequence
        _, once = np.unique(np.rec.fromarrays([text, h[at]]), return_index=True)
        for t, a in zip(text[once].tolist(), at[once].tolist()):
            for key in items.get(tuple(words[a : a + n].view(np.int64).tolist()), ()):
                yield t, key


def best_parts(block: dict, params: LatentParams, few: int = 8) -> np.ndarray:
    """What a unit of each word adds to a cosine over its least value, at best for each ``few`` passages.

    Nothing where a passage is so badly held by the space that any cosine will do.
    """
    least = params.cosine * block["own"]
    if not len(least) or least.min() < 1e-3:
        return np.zeros((0, 0), np.float32)
    parts = np.maximum(block["v"] @ block["latent"].T / least[None, :], 0)
    return np.maximum.reduceat(parts, np.arange(0, len(least), few), axis=1)


def common_subsequence(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, a machine word of the item at a time."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in text:
        hit = row & masks.get(w, 0)
        if hit:
            row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


def candidates(words: np.ndarray, before: np.ndarray, idf: np.ndarray, block: dict, params: LatentParams):
    """(text, first word, passage, cosine) of windows near a passage in the block's latent space.

    A window's cosine is at most the share of its norm in words of the vocabulary, and at most what
    its words add at best for any passage, or for any of a few passages: windows below these bounds
    are not folded in.
    """
    vocabulary, window = block["vocabulary"], block["window"]
    stride = window // (2 if window > min(params.windows) else 4)
    weight = idf[(words % np.uint64(len(idf))).astype(np.int64)] ** 2
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    known = vocabulary[at] == words
    all_sum = np.concatenate([[0.0], np.cumsum(weight)])
    known_sum = np.concatenate([[0.0], np.cumsum(np.where(known, weight, 0.0))])
    lengths = np.diff(before)
    n = np.where(lengths > 0, 1 + np.maximum(-(-(lengths - window) // stride), 0), 0)
    text = np.repeat(np.arange(len(n)), n)
    begin = before[text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * stride
    end = np.minimum(begin + window, before[text + 1])
    norm, inside = all_sum[end] - all_sum[begin], known_sum[end] - known_sum[begin]
    least = params.cosine * block["own"]
    near = (inside > 0) & (inside >= norm * float(least.min()) ** 2)
    best = block["best"]
    if len(best):
        most = np.concatenate([[0.0], np.cumsum(np.where(known, np.sqrt(weight) * best.max(axis=1)[at], 0.0))])
        near &= most[end] - most[begin] >= np.sqrt(norm) * _ROUNDING
    near = np.flatnonzero(near)
    for a in range(0, len(near), 512):
        some = near[a : a + 512]
        size = end[some] - begin[some]
        row = np.repeat(np.arange(len(some)), size)
        place = np.repeat(begin[some] - (np.cumsum(size) - size), size) + np.arange(len(row))
        row, column, w = row[known[place]], at[place][known[place]], np.sqrt(weight[place][known[place]])
        pair, first, counts = np.unique(row * len(vocabulary) + column, return_index=True, return_counts=True)
        value = (np.sqrt(counts) * w[first]).astype(np.float32)
        row, column = pair // len(vocabulary), pair % len(vocabulary)
        if len(best):
            added = np.zeros((len(pair) + 1, best.shape[1]))
            np.cumsum(best[column] * value[:, None], axis=0, dtype=float, out=added[1:])
            edges = np.searchsorted(row, np.arange(len(some) + 1))
            kept = ((added[edges[1:]] - added[edges[:-1]]).max(axis=1) >= np.sqrt(norm[some]) * _ROUNDING)
            if not kept.any():
                continue
            some, mine = some[kept], kept[row]
            row, column, value = (np.cumsum(kept) - 1)[row[mine]], column[mine], value[mine]
        dense = np.zeros((len(some), len(vocabulary)), np.float32)
        dense[row, column] = value
        cosine = dense @ block["v"] @ block["latent"].T / np.sqrt(norm[some])[:, None].astype(np.float32)
        hit, passage = np.nonzero(cosine >= least[None, :])
        for i, p in zip(hit.tolist(), passage.tolist()):
            yield int(text[some[i]]), int(begin[some[i]]), p, float(cosine[i, p])


def leaks(docs: DataFrame, items: DataFrame, params: LatentParams = LatentParams()) -> DataFrame:
    """(doc_id, hash, item_id, cosine, overlap, answer): items that a document holds, one row each.

    ``docs``: (doc_id, text, …), ``items``: (item_id, text, …); hash is that of the text. ``overlap``
    and ``answer`` are the shares of the item's words, and of its last words, that the document has
    in order near the candidate window. An item counts if ``overlap`` reaches ``verbatim``, or
    ``overlap`` and ``answer`` reach their bounds. An item of fewer than ``exact`` words counts if all
    its words follow each other in the text, be it a single word; an item without words never does.
    Items without id are searched too (item_id null); texts under the same id are items each, equal
    rows one. Null and empty texts hold nothing. Repeated rows of ``docs`` give their rows each.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("hash"), "text").where("text IS NOT NULL")
    total, frequency = document_frequencies(own, params.buckets)
    idf = np.log1p((total + 1) / (frequency + 1)).astype(np.float32)
    spaces = cut_lineage(latent_blocks(items, idf, params))
    numbers = sorted(r["block"] for r in spaces.select("block").distinct().collect())
    schema = "doc_id long, hash long, item_id long, cosine double, overlap double, answer double"
    context = docs.sparkSession.sparkContext
    out = docs.sparkSession.createDataFrame([], schema)
    for first in range(0, len(numbers), params.rounds):
        some = collected(spaces.where(F.col("block").isin(numbers[first : first + params.rounds])))
        for block in some:
            if "window" in block:
                block["best"] = best_parts(block, params)
        held = context.broadcast((idf, some))
        found = own.mapInArrow(_search(held, params), schema)
        if len(numbers) <= params.rounds:
            return found
        # a few blocks at a time are broadcast, whatever the benchmark's size
        out = out.unionByName(cut_lineage(found))
        held.unpersist()
    return out


def _search(held, params: LatentParams):
    def run(batches):
        idf, blocks = held.value
        for batch in batches:
            data, at = folded(batch.column(2))
            rows = []
            for low, high in slices(at):
                words, before = hashed(data[at[low] : at[high]], at[low : high + 1] - at[low])
                for block in blocks:
                    if "window" not in block:
                        rows += [(low + text, block["ids"][key], 1.0, 1.0, 1.0) for text, key in whole_items(words, before, block)]
                        continue
                    best: dict[tuple[int, int], tuple] = {}
                    for text, begin, passage, cosine in candidates(words, before, idf, block, params):
                        item = int(block["item"][passage])
                        whole = block["texts"][item]
                        a = max(begin - len(whole), int(before[text]))
                        b = min(begin + block["window"] + len(whole), int(before[text + 1]))
                        near = words[a:b].view(np.int64).tolist()
                        overlap = common_subsequence(whole.tolist(), near) / len(whole)
                        if overlap < params.overlap:
                            continue
                        last = whole[-max(1, round(len(whole) * params.answer_share)) :].tolist()
                        answer = common_subsequence(last, near) / len(last)
                        if overlap >= params.verbatim or answer >= params.answer:
                            best[text, item] = max(best.get((text, item), (0.0,)), (overlap, answer, cosine))
                    for (text, item), (overlap, answer, cosine) in best.items():
                        rows.append((low + text, block["ids"][item], cosine, overlap, answer))
            if rows:
                text, *rest = zip(*rows)
                at_rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at_rows), batch.column(1).take(at_rows), *(pa.array(c, t) for c, t in zip(rest, (pa.int64(), *[pa.float64()] * 3)))],
                    ["doc_id", "hash", "item_id", "cosine", "overlap", "answer"],
                )

    return run


def without_leaks(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``leaks`` names; all columns stay."""
    # stored: with its size known, Spark broadcasts it if small and does not shuffle the documents
    rows = cut_lineage(found.select(F.col("doc_id").alias("held_id"), F.col("hash").alias("held_hash")).distinct())
    # whole rows travel as one struct, so no column of theirs can clash
    own = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("hash"), F.struct("*").alias("row"))
    same = F.col("doc").eqNullSafe(F.col("held_id")) & (F.col("hash") == F.col("held_hash"))
    return own.join(rows, same, "left_anti").select("row.*")
