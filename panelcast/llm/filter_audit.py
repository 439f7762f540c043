"""How text filters interact: what each removes, alone and after the others, in every order."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice, permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.term_matrix import compressed_rows, encoded, packed, string_hashes
from panelcast.llm.words import slices, utf8
from panelcast.runtime import cut_lineage

FILTERS = "ABCDE"


@dataclass(frozen=True)
class AuditParams:
    least_words: int = 200  # A
    least_distinct: int = 50  # B: distinct words, in percent of all
    most_capitals: int = 3  # C: in percent of all characters
    symbols: str = "#$%&*|"  # D
    shard_bytes: int = 4 << 20  # of text; a longer text is a shard of its own
    bucket_words: int = 1 << 17  # entries of the shards' dictionaries that are numbered together


# --- the document-term matrix -----------------------------------------------------------------

Measure = Callable[[pa.Array], dict[str, pa.Array]]


def local_shards(docs: DataFrame, shard_bytes: int, measure: Measure, measured: str) -> DataFrame:
    """Shards of consecutive documents, each a CSR matrix over its own dictionary ``words``.

    ``docs``: text, and other columns, which become one struct per matrix row in ``rows`` together
    with what ``measure`` finds in the texts. Words are numbered by their hashes, ascending. Shards
    are numbered within the task, so a repeated task numbers them alike.
    """
    rest = [c for c in docs.columns if c != "text"]
    fields = ", ".join(f"`{c}`: {t}" for c, t in docs.select(*rest).dtypes)
    row = f"struct<{', '.join(filter(None, [fields, measured]))}>"
    schema = f"shard bigint, rows array<{row}>, indptr array<int>, indices array<int>, counts array<int>, words array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(utf8(texts)[1], shard_bytes):
                some = texts.slice(a, b - a)
                runs, before = packed(some)
                numbers, words = encoded(runs)
                order = np.argsort(string_hashes(words), kind="stable")
                place = np.empty(len(words), np.int64)
                place[order] = np.arange(len(words))
                csr = compressed_rows(place[numbers], before, len(words))
                found = {**{c: batch.column(c).slice(a, b - a) for c in rest}, **measure(some)}
                rows = pa.StructArray.from_arrays(list(found.values()), list(found))
                lists = [one(rows), *[one(pa.array(x.astype(np.int32))) for x in csr], one(words.take(pa.array(order)).cast(pa.string()))]
                yield pa.RecordBatch.from_arrays([pa.array([shard]), *lists], ["shard", "rows", "indptr", "indices", "counts", "words"])
                shard += 1

    return docs.select("text", *rest).mapInArrow(run, schema)


def one(values: pa.Array) -> pa.Array:
    """A list array with all ``values`` in its only row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def pieces(local: DataFrame, buckets: int) -> DataFrame:
    """(bucket, shard, words): each shard's dictionary cut at equal steps of the hash, space-joined."""
    edges = np.array([(i << 64) // buckets for i in range(buckets)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, words in zip(batch.column("shard").to_pylist(), batch.column("words")):
                cuts = np.append(np.searchsorted(string_hashes(words.values), edges), len(words.values))
                full = np.flatnonzero(np.diff(cuts))
                lists = pa.ListArray.from_arrays(pa.array(np.append(cuts[full], cuts[-1]).astype(np.int32)), words.values)
                joined = pc.binary_join(lists, " ")
                yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(np.full(len(full), shard)), joined], ["bucket", "shard", "words"])

    return local.select("shard", "words").mapInArrow(run, "bucket bigint, shard bigint, words string")


def numbered(parts: DataFrame) -> DataFrame:
    """(bucket, shard, ids, fresh): the words of ``pieces`` numbered per bucket in order of appearance.

    ``fresh`` are those that no earlier row of the bucket has. A task holds the distinct words of one
    bucket at a time, however many shards have them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known = None, {}
        for batch in batches:
            found = {"ids": [], "fresh": []}
            for bucket, words in zip(batch.column("bucket").to_pylist(), batch.column("words")):
                if bucket != at:
                    at, known = bucket, {}
                old = len(known)
                ids = [known.setdefault(w, len(known)) for w in words.as_py().split(" ")]
                found["ids"].append(one(pa.array(ids, pa.int32())))
                found["fresh"].append(one(pa.array([*islice(reversed(known), len(known) - old)][::-1], pa.string())))
            lists = [pa.concat_arrays(x) for x in found.values() if x]
            if lists:
                yield pa.RecordBatch.from_arrays([batch.column("bucket"), batch.column("shard"), *lists], ["bucket", "shard", "ids", "fresh"])

    dealt = parts.repartition("bucket").sortWithinPartitions("bucket", "shard")
    return dealt.mapInArrow(run, "bucket bigint, shard bigint, ids array<int>, fresh array<string>")


def document_terms(
    docs: DataFrame, params: AuditParams, measure: Measure = lambda texts: {}, measured: str = ""
) -> tuple[DataFrame, DataFrame]:
    """CSR shards over one dictionary of all words, and the dictionary (word, id), ids without gaps.

    ``docs``: text (null: empty) and other columns. A shard has ``rows`` (one struct per document of
    the other columns and what ``measure`` finds), ``indptr``, ``indices`` (word ids) and ``counts``.
    Texts are split in one pass. The dictionaries of the shards then meet by hash, cut into so many
    buckets that one has about ``bucket_words`` entries, and go back as numbers; a frequent word is
    one entry per shard at most.
    """
    local = cut_lineage(local_shards(docs, params.shard_bytes, measure, measured), group_bytes=params.shard_bytes)
    entries = local.agg(F.coalesce(F.sum(F.size("words").cast("long")), F.lit(0))).first()[0]
    known = cut_lineage(numbered(pieces(local, max(1, -(-entries // params.bucket_words)))))
    # one row per bucket meets in one task
    sizes = known.groupBy("bucket").agg(F.sum(F.size("fresh").cast("long")).alias("n"))
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = cut_lineage(sizes.select("bucket", F.coalesce(before, F.lit(0)).alias("start")))
    new = known.select("bucket", "shard", "fresh").where("size(fresh) > 0").join(starts, "bucket")
    past = F.sum(F.size("fresh").cast("long")).over(Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    words = new.withColumn("start", F.col("start") + F.coalesce(past, F.lit(0))).select("start", F.posexplode("fresh").alias("i", "word"))
    global_ids = known.join(starts, "bucket").select(F.col("shard").alias("of"), "bucket", "start", "ids")
    shards = local.drop("words")
    row = shards.schema["rows"].dataType.simpleString()

    def globally(shard: pa.Table, ids: pa.Table) -> pa.Table:
        ids = ids.sort_by("bucket").combine_chunks()
        at = ids.column("ids").combine_chunks()
        size = pc.list_value_length(at).to_numpy() if ids.num_rows else np.zeros(0, np.int64)
        number = np.repeat(ids.column("start").to_numpy(), size) + at.flatten().to_numpy()
        indices = shard.column("indices").combine_chunks().values.to_numpy()
        return shard.set_column(shard.column_names.index("indices"), "indices", one(pa.array(number[indices], pa.int64())))

    schema = f"shard bigint, rows {row}, indptr array<int>, indices array<bigint>, counts array<int>"
    encoded_shards = shards.groupBy("shard").cogroup(global_ids.groupBy("of")).applyInArrow(globally, schema)
    return encoded_shards, words.select("word", (F.col("start") + F.col("i")).alias("id"))


def row_sums(shards: DataFrame) -> DataFrame:
    """Per matrix row: the columns in ``rows``, ``n_words`` (row sum), ``n_distinct`` (nonzero cells).

    In expressions, so that no second Python worker stands beside the one that made the shards.
    """
    fields = shards.schema["rows"].dataType.elementType.names

    def sums(row: Column, i: Column) -> Column:
        first, cells = F.get("indptr", i), F.get("indptr", i + 1) - F.get("indptr", i)
        total = F.aggregate(F.slice("counts", first + 1, cells), F.lit(0).cast("long"), lambda acc, n: acc + n)
        return F.struct(*[row[f].alias(f) for f in fields], total.alias("n_words"), cells.cast("long").alias("n_distinct"))

    return shards.select(F.inline(F.transform("rows", sums)))


# --- the audit --------------------------------------------------------------------------------

def flags(params: AuditParams) -> Measure:
    """Per text: c, too many capitals; d, holds a symbol; digest, SHA-256."""
    wanted = np.zeros(256, bool)
    wanted[list(params.symbols.encode())] = True

    def measure(texts: pa.Array) -> dict[str, pa.Array]:
        data, at = utf8(texts)

        def held(mask: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(np.flatnonzero(mask), at))

        capitals = held((data >= 65) & (data <= 90))
        characters = np.diff(at) - held((data & 0xC0) == 0x80)  # bytes that continue a character
        view = memoryview(np.ascontiguousarray(data))
        digests = [hashlib.sha256(view[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        many = 100 * capitals > params.most_capitals * characters
        return {"c": pa.array(many), "d": pa.array(held(wanted[data]) > 0), "digest": pa.array(digests, pa.binary())}

    return measure


def failures(docs: DataFrame, params: AuditParams = AuditParams()) -> DataFrame:
    """(doc_id, part, fails): one bit per filter that a document fails, A the lowest.

    ``docs``: doc_id, text, lang; other columns are ignored, whatever their names. A document
    without text counts as empty. E compares SHA-256 digests of whole texts and counts documents
    with a smaller doc_id; a document without doc_id has none larger and comes after all others,
    repeated ids are not smaller than each other.
    """
    own = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"))
    shards, _ = document_terms(own, params, flags(params), "c: boolean, d: boolean, digest: binary")
    sums = row_sums(shards)
    few = F.col("n_words") < params.least_words
    same = 100 * F.col("n_distinct") < params.least_distinct * F.col("n_words")
    bits = few.cast("int") + 2 * same.cast("int") + 4 * F.col("c").cast("int") + 8 * F.col("d").cast("int")
    known = cut_lineage(sums.select("doc_id", "part", "digest", bits.alias("bits")))
    copies = known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.col("doc_id").isNull() & F.col("first").isNotNull(), F.lit(False))
    return known.join(copies, "digest", "left").select("doc_id", "part", (F.col("bits") + 16 * later.cast("int")).alias("fails"))


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, bit of the step's filter, bits of those before) for each order and step."""
    return [
        ("".join(p), i + 1, 1 << filters.index(f), sum(1 << filters.index(e) for e in p[:i]))
        for p in permutations(filters) for i, f in enumerate(p)
    ]


def interactions(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """The report on ``failures``: one row per part, order and step.

    Documents are first counted per part and set of failed filters (32 at most), so the orders meet
    no documents. ``labels``: doc_id, quality, toxic; a document that has several rows there is good
    or toxic if one of them says so.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    counted = failed.join(marks, "doc_id", "left").groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets"))
    steps = F.array(*[F.struct(*map(F.lit, s)) for s in orders()])
    rows = parts.select("part", "sets", F.inline(steps).alias("filter_order", "step", "own", "before"))

    def total(value, where) -> Column:
        return F.aggregate(F.filter("sets", where), F.lit(0).cast("long"), lambda acc, s: acc + value(s))

    own, before = F.col("own"), F.col("before")
    fails = lambda s: s["fails"].bitwiseAND(own) != 0
    gone = lambda s: s["fails"].bitwiseAND(before) != 0
    here = lambda s: fails(s) & ~gone(s)
    n = lambda s: s["n"]
    # in 1 of bit_count(fails) orders its filter comes first of those that a document fails
    share = lambda s: (s["n"] * F.lit(len(orders()) // len(FILTERS))) / F.bit_count(s["fails"])
    return rows.select(
        "part", "filter_order", "step",
        total(n, lambda s: ~fails(s) & ~gone(s)).alias("kept"),
        total(n, here).alias("removed"),
        total(n, lambda s: fails(s) & gone(s)).alias("redundant"),
        total(n, lambda s: s["fails"] == own).alias("unique_fails"),
        total(lambda s: s["good"], here).alias("good_lost"),
        total(lambda s: s["toxic"], here).alias("toxic_lost"),
        total(lambda s: share(s).cast("long"), fails).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, params: AuditParams = AuditParams()) -> DataFrame:
    """What five filters remove, per language (``part``; null is empty), order and step.

    A row for each of the 120 orders and five steps of every part that occurs, zeros included: kept
    after the step, removed by it, redundant, unique_fails, good_lost, toxic_lost, and shapley, the
    filter's removals over all orders. No documents: no rows.
    """
    return interactions(failures(docs, params), labels)
