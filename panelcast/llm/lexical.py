"""Ranked lexical search: bounds from hashed max-sketches, exact scores until none can enter the top k."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.term_matrix import compressed_rows, encoded, packed, string_hashes
from panelcast.llm.words import mix, slices, utf8
from panelcast.runtime import cut_lineage

# A term is a longest run of ASCII letters, digits and characters beyond ASCII, A-Z in lower case.
TERM_BYTES = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

# A coordinate holds a term count in two bits: none, 1, up to 3, more.
STEPS = np.array([1, 3], np.int64)
MORE = len(STEPS) + 1
UNIT, SLOPE, LENGTH = 1_000_000_000, 1000, 20  # an impact is UNIT * tf div (SLOPE * tf + LENGTH * m)
FLAT, FULL = 50, 100  # m is FULL - FLAT + (FLAT * n * N) div L


@dataclass(frozen=True)
class RankParams:
    k: int = 50
    spread: int = 16  # coordinates of a sketch per distinct term, rounded up to a power of two
    hashes: int = 4  # coordinates of a term
    slice_bytes: int = 2 << 20  # of text that one step of a task holds
    step_cells: int = 1 << 20  # documents × (queries + terms) that one step of a task holds
    block_terms: int = 1 << 20  # terms of the queries searched in one pass over the sketches
    broadcast_rows: int = 1 << 20  # first candidates, at most k per query, are broadcast up to here
    group: int = 256  # documents scored exactly before bounds are looked at again


# --- the index --------------------------------------------------------------------------------

def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return packed(column, TERM_BYTES, LOWER)


def coordinates(terms: pa.Array, hashes: int) -> np.ndarray:
    """``hashes`` 64-bit hashes of each term; the low bits are its coordinates."""
    first = string_hashes(terms)
    return np.stack([mix(first + np.uint64(i)) for i in range(hashes)])


def sketched(hashes: np.ndarray, indptr: np.ndarray, indices: np.ndarray, counts: np.ndarray, spread: int) -> tuple[np.ndarray, np.ndarray]:
    """The sketches of CSR rows one after the other, four coordinates a byte, and where each begins.

    A coordinate holds the largest count, as a code, among the terms that hash to it.
    """
    distinct = np.diff(indptr)
    width = np.where(distinct, 1 << np.ceil(np.log2(np.maximum(distinct * spread, 4))).astype(np.int64), 0)
    begins = np.concatenate([[0], np.cumsum(width)])
    row = np.repeat(np.arange(len(distinct)), distinct)
    code = (np.searchsorted(STEPS, counts) + 1).astype(np.uint8)
    held = np.zeros(begins[-1], np.uint8)
    for own in hashes:
        np.maximum.at(held, begins[row] + (own[indices] & (width[row] - 1).astype(np.uint64)).astype(np.int64), code)
    quarters = held.reshape(-1, 4)
    return quarters[:, 0] | quarters[:, 1] << 2 | quarters[:, 2] << 4 | quarters[:, 3] << 6, begins // 4


def index(docs: DataFrame, params: RankParams = RankParams()) -> tuple[DataFrame, DataFrame]:
    """(sketches, vocabulary) of ``docs`` (doc_id, text; other columns are ignored), stored.

    sketches: row (unique), doc_id, text, n (terms with repeats), sketch. vocabulary: slices of the
    corpus as terms and in how many documents of the slice each occurs. Both come from one pass, and
    neither depends on the queries.
    """
    schema = "kind int, row bigint, doc_id bigint, text string, n bigint, sketch binary, terms array<string>, holders array<int>"
    types = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int32())]
    names = ["kind", "row", "doc_id", "text", "n", "sketch", "terms", "holders"]

    def made(size: int, **columns) -> pa.RecordBatch:
        filled = [columns[c].cast(t) if c in columns else pa.nulls(size, t) for c, t in zip(names, types)]
        return pa.RecordBatch.from_arrays(filled, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(utf8(texts)[1], params.slice_bytes):
                runs, before = terms_of(texts.slice(a, b - a))
                numbers, terms = encoded(runs)
                indptr, indices, counts = compressed_rows(numbers, before, len(terms))
                held, begins = sketched(coordinates(terms, params.hashes), indptr, indices, counts, params.spread)
                sketch = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(held)])
                yield made(
                    b - a, kind=pa.array(np.zeros(b - a, np.int32)), row=pa.array(np.arange(row, row + b - a)),
                    doc_id=batch.column("doc_id").slice(a, b - a), text=texts.slice(a, b - a), n=pa.array(np.diff(before)), sketch=sketch,
                )
                row += b - a
                if len(terms):
                    holders = pa.array(np.bincount(indices, minlength=len(terms)).astype(np.int32))
                    ends = pa.array([0, len(terms)], pa.int32())
                    yield made(
                        1, kind=pa.array([1]), terms=pa.ListArray.from_arrays(ends, terms.cast(pa.string())),
                        holders=pa.ListArray.from_arrays(ends, holders),
                    )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stored = cut_lineage(read.mapInArrow(run, schema))
    sketches = stored.where("kind = 0").select("row", "doc_id", "text", "n", "sketch")
    return sketches, stored.where("kind = 1").select("terms", "holders")


def query_terms(items: DataFrame) -> DataFrame:
    """(query, item_id, term): the distinct terms of each row of ``items`` (item_id, text).

    Rows are told apart by ``query``, so repeated ids are separate queries; rows without terms vanish.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = TaskContext.get().partitionId() << 33
        for batch in batches:
            runs, before = terms_of(batch.column("text"))
            numbers, terms = encoded(runs)
            indptr, indices, _ = compressed_rows(numbers, before, len(terms))
            row = np.repeat(np.arange(batch.num_rows), np.diff(indptr))
            yield pa.RecordBatch.from_arrays(
                [pa.array(query + row), batch.column("item_id").take(pa.array(row)), terms.take(pa.array(indices)).cast(pa.string())],
                ["query", "item_id", "term"],
            )
            query += batch.num_rows

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"query bigint, item_id {kind}, term string")


# --- scores -----------------------------------------------------------------------------------

class Block:
    """The terms of some queries as a sparse matrix, with weights from how many documents hold them."""

    def __init__(self, rows: pd.DataFrame, documents: int, total: int, hashes: int):
        rows = rows[rows["df"] > 0]  # no document holds the others
        self.documents, self.total = documents, total
        self.queries, query = np.unique(rows["query"].to_numpy(np.int64), return_inverse=True)
        self.vocabulary, first, term = np.unique(rows["term"].to_numpy(object), return_index=True, return_inverse=True)
        df = rows["df"].to_numpy(np.int64)[first]
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        self.hashes = coordinates(pa.array(self.vocabulary, pa.large_string()), hashes)
        by_term = np.argsort(term, kind="stable")
        self.of_query = query[by_term]
        self.ptr = np.searchsorted(term[by_term], np.arange(len(df) + 1))

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = FULL - FLAT + (FLAT * n * self.documents) // self.total
        return (UNIT * tf) // (SLOPE * tf + LENGTH * m)

    def added(self, row: np.ndarray, term: np.ndarray, impact: np.ndarray, rows: int) -> np.ndarray:
        """rows × queries: the sums of weighted impacts, each term added to all queries that hold it."""
        deg = np.diff(self.ptr)[term]
        step = np.arange(deg.sum()) - np.repeat(np.cumsum(deg) - deg, deg)
        cell = np.repeat(row, deg) * len(self.queries) + self.of_query[np.repeat(self.ptr[term], deg) + step]
        value = np.repeat(self.weights[term] * impact, deg)
        size = rows * len(self.queries)
        if len(value) and float(value.max()) * len(self.vocabulary) < 2.0**53:  # sums of doubles are exact
            out = np.bincount(cell, value, size).astype(np.int64)
        else:
            out = np.zeros(size, np.int64)
            np.add.at(out, cell, value)
        return out.reshape(rows, len(self.queries))

    def bounds(self, sketches: pa.Array, n: np.ndarray) -> np.ndarray:
        """rows × queries: no score is larger. A term's count is at most that of each of its coordinates."""
        flat, at = utf8(sketches)
        width = 4 * np.diff(at)

        def looked_up(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
            place = (hashes & np.maximum(width[row] - 1, 0).astype(np.uint64)).astype(np.int64)
            return flat[at[row] + (place >> 2)] >> ((place & 3) << 1).astype(np.uint8) & 3

        some = np.flatnonzero(width)
        if not len(some):
            return np.zeros((len(n), len(self.queries)), np.int64)
        codes = looked_up(some[:, None], self.hashes[0][None, :])
        i, term = np.nonzero(codes)
        row, code = some[i], codes[i, term]
        for hashes in self.hashes[1:]:
            code = np.minimum(code, looked_up(row, hashes[term]))
            row, term, code = row[code > 0], term[code > 0], code[code > 0]
        most = np.append(STEPS, 0)[np.minimum(code, MORE) - 1]
        impact = np.where(code == MORE, UNIT // SLOPE, self.impacts(np.maximum(most, 1), n[row]))
        return self.added(row, term, impact, len(n))

    def scores(self, texts: pa.Array, n: np.ndarray) -> np.ndarray:
        """rows × queries: the exact scores."""
        runs, before = terms_of(texts)
        known = pc.index_in(runs, value_set=pa.array(self.vocabulary, pa.large_string()))
        number = known.fill_null(-1).to_numpy().astype(np.int64)
        inside = np.concatenate([[0], np.cumsum(number >= 0)])[before]
        indptr, term, tf = compressed_rows(number[number >= 0], inside, len(self.vocabulary))
        row = np.repeat(np.arange(len(n)), np.diff(indptr))
        return self.added(row, term, self.impacts(tf, n[row]), len(n))


class Best:
    """Each query's k best rows so far, and the score below which no row enters."""

    def __init__(self, kth: np.ndarray, k: int):
        self.kth, self.k = np.maximum(kth, 1), k  # a score must be above 0
        self.pool = [np.zeros(0, np.int64)] * 3  # query, score, key; and what else the caller adds

    def add(self, query: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        self.pool = [np.concatenate(c) for c in zip(self.pool, (query, score, key))]
        query, score, key = self.pool
        order = np.lexsort((key, ~score, query))
        held = query[order]
        rank = np.arange(len(order)) - np.searchsorted(held, held)
        last = order[rank == self.k - 1]
        self.kth[query[last]] = np.maximum(self.kth[query[last]], score[last])
        self.pool = [c[order[rank < self.k]] for c in self.pool]


def steps(batches: Iterator[pa.RecordBatch], block: Block, params: RankParams) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows × (queries + terms) stays bounded."""
    size = max(1, params.step_cells // max(1, len(block.queries) + len(block.vocabulary)))
    for batch in batches:
        for a in range(0, batch.num_rows, size):
            yield batch.slice(a, size)


def first_candidates(sketches: DataFrame, block: Block, params: RankParams) -> DataFrame:
    """(query, row): the k rows of each query with the best bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(np.ones(len(block.queries), np.int64), params.k)
        for batch in steps(batches, block, params):
            bound = block.bounds(batch.column("sketch"), batch.column("n").to_numpy())
            i, q = np.nonzero(bound >= best.kth[None, :])
            best.add(q, bound[i, q], batch.column("row").to_numpy()[i])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.pool], ["query", "bound", "row"])

    near = sketches.select("row", "n", "sketch").mapInArrow(run, "query bigint, bound bigint, row bigint")
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "row")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.k).select("query", "row")


def thresholds(sketches: DataFrame, block: Block, params: RankParams) -> np.ndarray:
    """A score that each query's k-th best row reaches: the k-th exact score of its first candidates."""
    first = cut_lineage(first_candidates(sketches, block, params))
    rows = first.groupBy("row").agg(F.collect_set("query").alias("queries"))
    if params.k * len(block.queries) <= params.broadcast_rows:
        rows = F.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, block, params):
            score = block.scores(batch.column("text"), batch.column("n").to_numpy())
            asked = batch.column("queries")
            i = np.repeat(np.arange(batch.num_rows), pc.list_value_length(asked).to_numpy())
            q = asked.flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(score[i, q])], ["query", "score"])

    exact = sketches.join(rows, "row").select("text", "n", "queries").mapInArrow(run, "query bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    kth = exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == params.k)
    out = np.zeros(len(block.queries), np.int64)
    for r in kth.select("query", "score").collect():  # one number per query of the block
        out[r["query"]] = r["score"]
    return out


def swept(sketches: DataFrame, block: Block, kth: np.ndarray, params: RankParams) -> DataFrame:
    """(query, score, doc_id) of the rows that can be among a query's k best.

    Documents whose bound reaches a threshold are scored exactly, those with the largest margin
    first; what a task finds raises its thresholds, until no bound is left above them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(kth.copy(), params.k)
        for batch in steps(batches, block, params):
            n = batch.column("n").to_numpy()
            # rows without doc_id come after all others
            key = batch.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            bound = block.bounds(batch.column("sketch"), n)
            todo = np.argsort(-(bound / best.kth[None, :]).max(axis=1), kind="stable")
            while len(todo):
                todo = todo[(bound[todo] >= best.kth[None, :]).any(axis=1)]
                some, todo = todo[: params.group], todo[params.group :]
                if len(some):
                    score = block.scores(batch.column("text").take(pa.array(some)), n[some])
                    i, q = np.nonzero(score >= best.kth[None, :])
                    best.add(q, score[i, q], key[some][i])
        query, score, key = best.pool
        doc_id = pa.array(key, mask=key == np.iinfo(np.int64).max)
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(score), doc_id], ["query", "score", "doc_id"])

    return sketches.select("doc_id", "text", "n", "sketch").mapInArrow(run, "query bigint, score bigint, doc_id bigint")


# --- the search -------------------------------------------------------------------------------

def ranked_search(docs: DataFrame, items: DataFrame, params: RankParams = RankParams()) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are ignored. A term's impact in a
    document grows with its count, so a sketch of the largest count per coordinate also has the
    largest impact per coordinate, once the corpus' mean length is known. A term has several
    coordinates; the least of their impacts bounds its own. A query's bound is the sum of its terms'
    weights times these.

    Each pass over the sketches answers a block of queries of bounded size: first the k best bounds
    per query are scored, which gives a threshold, then all documents whose bounds reach it. Equal
    scores go by doc_id; rows without doc_id count as documents and come last. Rows that repeat an id
    are documents, or items, of their own. Null and empty texts have no terms: such documents are
    never found and such items find nothing.
    """
    spark = docs.sparkSession
    sketches, vocabulary = index(docs, params)
    documents, total = sketches.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked = cut_lineage(query_terms(items))
    schema = f"item_id {dict(asked.dtypes)['item_id']}, rank int, doc_id bigint, score bigint"
    n_asked = asked.count()
    if not documents or not n_asked:
        return spark.createDataFrame([], schema)
    wanted = asked.select("term").distinct()
    held = vocabulary.select(F.inline(F.arrays_zip("terms", "holders"))).join(wanted, F.col("terms") == F.col("term"), "left_semi")
    known = held.groupBy(F.col("terms").alias("term")).agg(F.sum("holders").alias("df"))
    weighed = cut_lineage(asked.join(known, "term"))
    blocks = -(-n_asked // params.block_terms)
    found = []
    for b in range(blocks):
        rows = weighed.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).select("query", "term", "df").toPandas()
        block = Block(rows, documents, total, params.hashes)
        if len(block.queries):
            local = swept(sketches, block, thresholds(sketches, block, params), params)
            order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
            best = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.k)
            names = spark.createDataFrame(pd.DataFrame({"at": np.arange(len(block.queries)), "own": block.queries}))
            found.append(cut_lineage(best.join(names, F.col("query") == F.col("at")).select("own", "rank", "doc_id", "score")))
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    items_of = asked.select("query", "item_id").distinct()
    return out.join(items_of, F.col("own") == F.col("query")).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
