"""SimHash fingerprints and the exact join of fingerprints within a few bits.

Pivot tables alone cannot deal out the work: the distance of a random 64-bit fingerprint to any
reference is 32 give or take 4, so a difference of at most 4 leaves more than half of all pairs
for each reference. Pairs are therefore met first in buckets that agree on whole blocks of bits
(with 4 + j blocks, two fingerprints within 4 bits agree on j of them). Inside a bucket the pivot
table discards pairs, coordinate by coordinate, and the survivors are verified.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.components import components
from panelcast.llm.words import mix, utf8
from panelcast.runtime import cut_lineage

PIVOTS = 16
BUCKET_ROWS = 4096  # a larger bucket is cut into blocks, and its blocks meet in pairs
BUCKET_GOAL = 64  # wanted mean size of a bucket


def simhash(words: list[bytes], shingle: int) -> int:
    """The fingerprint of one text: a bit is set if it is set in over half the shingles' hashes."""
    if not words:
        return 0
    text = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[s:e], 42) for s, e in zip(starts, ends)), np.uint64, len(ends))
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    ones = [np.bincount(lanes[:, k], minlength=256) @ _BITS for k in range(8)]
    return sum(1 << i for i, n in enumerate(np.concatenate(ones)) if 2 * n > len(ends))


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, hash, fp) of each row: the text's hash, and the unsigned fingerprint's bits as a long.

    A-Z are lower-cased. Fewer words than ``shingle``: the whole sequence is the only shingle. No
    words, or null: 0.
    """

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column(1))
            raw = data.tobytes()
            out = np.array(
                [simhash(raw[at[i] : at[i + 1]].lower().split(), shingle) for i in range(len(at) - 1)], np.uint64
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out.view(np.int64))], ["doc_id", "hash", "fp"])

    own = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("hash"))
    return own.mapInArrow(run, "doc_id long, hash long, fp long")


def block_masks(max_bits: int, agree: int) -> list[int]:
    """Masks of every choice of ``agree`` of ``max_bits + agree`` blocks, as signed longs."""
    edges = np.linspace(0, 64, max_bits + agree + 1).round().astype(int)
    blocks = [sum(1 << b for b in range(s, e)) for s, e in zip(edges[:-1], edges[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def agreeing_blocks(n: int, max_bits: int) -> int:
    """Fewest agreeing blocks whose buckets hold about BUCKET_GOAL of n fingerprints; 4 at most."""
    return next((j for j in (1, 2, 3) if n <= BUCKET_GOAL << (64 * j // (max_bits + j))), 4)


def near_fingerprints(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links (a, b) between the ``rep`` ids of distinct fingerprints (fp, rep) within ``max_bits``.

    Not every pair is returned, but a spanning forest of each bucket's links: enough for the
    components, and never more rows than the buckets have.
    """
    masks = block_masks(max_bits, agreeing_blocks(fps.count(), max_bits))
    keys = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
    entries = fps.select("fp", "rep", keys.alias("mask", "key"))
    sizes = entries.groupBy("mask", "key").agg(F.count("*").alias("size")).where("size > 1")
    return forests(entries.join(sizes, ["mask", "key"]), max_bits)


def forests(entries: DataFrame, max_bits: int) -> DataFrame:
    """Spanning forests of the links in each bucket (mask, key); ``size`` is the bucket's size."""
    half = BUCKET_ROWS // 2
    parts = F.when(F.col("size") > BUCKET_ROWS, F.ceil(F.col("size") / half)).otherwise(1).cast("long")
    own = F.pmod(F.xxhash64("fp"), F.col("parts"))
    met: Column = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
        lambda j: F.least(F.col("own"), j) * F.col("parts") + F.greatest(F.col("own"), j),
    )
    dealt = (
        entries.withColumn("parts", parts)
        .withColumn("own", own)
        .select("mask", "key", F.explode(met).alias("block"), "fp", "rep")
        .repartition("mask", "key", "block")
        .sortWithinPartitions("mask", "key", "block", "fp")
    )

    def run(batches):
        rest = None
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            rows = rows if rest is None else np.concatenate([rest, rows], axis=1)
            last = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0))
            cut = last[-1] + 1 if len(last) else 0
            if cut >= 1 << 14:
                yield _linked(rows[:, :cut], max_bits)
                rows = rows[:, cut:]
            rest = rows
        if rest is not None:
            yield _linked(rest, max_bits)

    return dealt.mapInArrow(run, "a long, b long")


def pivot_table(fps: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances of each fingerprint to each of the fixed reference fingerprints."""
    refs = mix(np.arange(1, pivots + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.bitwise_count(fps[None, :] ^ refs[:, None]).astype(np.int8)


def _linked(rows: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Forest of the links between rows of one bucket; ``rows``: mask, key, block, fp, rep."""
    n = rows.shape[1]
    new = np.ones(n, bool)
    new[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    bucket = np.cumsum(new)
    fps, reps = rows[3].view(np.uint64), rows[4]
    table = pivot_table(fps)
    root = np.arange(n)
    out = []
    lag, left = 1, np.arange(n - 1)
    while len(left := left[left + lag < n]) and len(left := left[bucket[left] == bucket[left + lag]]):
        a = left[root[left] != root[left + lag]]
        for row in table:
            a = a[np.abs(row[a] - row[a + lag]) <= max_bits]
        a = a[np.bitwise_count(fps[a] ^ fps[a + lag]) <= max_bits]
        for x in a.tolist():
            r, s = x, x + lag
            while root[r] != r:
                r = root[r]
            while root[s] != s:
                s = root[s]
            if r != s:
                root[max(r, s)] = min(r, s)
                out.append((x, x + lag))
        while len(a) and (root[root] != root).any():
            root = root[root]
        lag += 1
    found = np.array(out, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(reps[found[:, 0]]), pa.array(reps[found[:, 1]])], ["a", "b"])


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id, hash) of each row of ``docs`` (doc_id, text, …); hash is the text's.

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id is the smallest doc_id
    that links lead to. Repeated rows and exact copies share a fingerprint, hence a component. A
    row without doc_id gets its fingerprint's component, or null if no row with an id has it.
    """
    prints = cut_lineage(fingerprints(docs, shingle))
    fps = prints.groupBy("fp").agg(F.min("doc_id").alias("rep")).where("rep IS NOT NULL")
    fps = cut_lineage(fps)
    roots = components(near_fingerprints(fps, max_bits))
    named = fps.join(roots, fps.rep == roots.node, "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    return prints.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "hash"
    )


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component that ``near_duplicates`` found in them; all columns stay.

    It is the one with the smallest doc_id; of texts under the same id, the one with the smallest
    hash; of rows equal in both, any one. Rows without doc_id whose component has no id at all are
    grouped by fingerprint. Only rows that repeat both id and text are grouped with their texts.
    """
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("x"), "fingerprint"))
    same = found.groupBy(group.alias("g"), "doc_id", "hash").agg(F.count("*").alias("n"))
    first = same.groupBy("g").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "n")).alias("k"))

    def id_of(column: str) -> Column:
        return F.coalesce(F.col(column).cast("long").cast("string"), F.lit(""))

    keep = first.select(id_of("k.doc_id").alias("doc"), F.col("k.hash").alias("hash"), F.col("k.n").alias("n"))
    # whole rows travel as one struct, so no column of theirs can clash
    own = docs.select(id_of("doc_id").alias("doc"), F.xxhash64("text").alias("hash"), F.struct("*").alias("row"))
    rows = own.join(keep, ["doc", "hash"])
    out = rows.where("n = 1").unionByName(rows.where("n > 1").dropDuplicates(["doc", "hash"]))
    return out.select("row.*")
