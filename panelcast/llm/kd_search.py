"""Exact top-k by inner product: a KD-tree per shard, opened best box first."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.ann import matrix
from panelcast.runtime import cut_lineage

NONE = np.iinfo(np.int64).min
PAIR = "query bigint, query_id bigint, vec_id bigint, score bigint"


@dataclass(frozen=True)
class KdParams:
    k: int = 20
    scale: float = 64.0
    shard_numbers: int = 1 << 20  # components in a shard
    chunk_numbers: int = 1 << 20  # components of the queries that meet a shard in one task
    leaf_rows: int = 256
    widen: int = 8  # each wave searches so many times the shards of the last one


def integer_vectors(vectors: DataFrame, scale: float) -> DataFrame:
    """(row, vec_id, dims, v): each component x as floor(scale * x), a whole double.

    Rows without vec_id take no part, nor do vectors that are null or hold a null or non-finite
    component; one that is no longer finite once scaled counts as such.
    """
    number = F.transform("embedding", lambda x: x.cast("double") * F.lit(float(scale)))
    clean = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), number.alias("v"))
    return rows.where(F.col("v").isNotNull() & clean).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", F.size("v").alias("dims"), "v"
    )


# --- numbers ----------------------------------------------------------------------------------

def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole doubles, held at the ends of 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(a) @ whole(b).T
    return np.clip(exact, NONE, -(NONE + 1)).astype(np.int64)


def best(query: np.ndarray, vec_id: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's ``k`` best pairs, ties to smaller ids, in order of query and rank."""
    order = np.lexsort((vec_id, ~score, query))
    sorted_query = query[order]
    first = np.searchsorted(sorted_query, sorted_query)
    return order[np.arange(len(order)) - first < k]


# --- one tree ---------------------------------------------------------------------------------

def grown(ids: np.ndarray, x: np.ndarray, leaf_rows: int) -> dict:
    """A complete binary tree: each node is cut at the median of its widest component.

    Rows are put in the order of the leaves. Node i has the children 2i + 1 and 2i + 2 and the
    tight box ``low[i]`` to ``high[i]``; leaf j holds the rows from ``cuts[j]`` to ``cuts[j + 1]``.
    """
    depth = max(0, int(np.ceil(np.log2(len(x) / leaf_rows)))) if len(x) else 0
    parts, low, high = [np.arange(len(x))], [], []
    for level in range(depth + 1):
        halves = []
        for rows in parts:
            box = x[rows]
            low.append(box.min(axis=0))
            high.append(box.max(axis=0))
            if level < depth:
                wide = box[:, int((high[-1] - low[-1]).argmax())] if x.shape[1] else np.zeros(len(rows))
                middle = len(rows) // 2
                halves += np.split(rows[np.argpartition(wide, middle)], [middle])
        parts = halves if level < depth else parts
    order = np.concatenate(parts)
    cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return {"ids": ids[order], "x": x[order], "low": np.array(low), "high": np.array(high), "cuts": cuts}


def open_leaves(tree: dict, q: np.ndarray, kth: np.ndarray) -> np.ndarray:
    """Queries × leaves: the largest inner product that the leaf's box allows, NONE where an
    ancestor's box already allows none of ``kth`` or more."""
    signs = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1)
    boxes = np.concatenate([tree["high"], tree["low"]], axis=1)
    alive, a = np.ones((len(q), 1), bool), 0
    while True:
        width = alive.shape[1]
        bound = products(signs, boxes[a : a + width])
        alive &= bound >= kth[:, None]
        a += width
        if a >= len(boxes):
            return np.where(alive, bound, NONE)
        alive = np.repeat(alive, 2, axis=1)


def searched(tree: dict, query: np.ndarray, query_id: np.ndarray, q: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(position in ``query``, vec_id, score) of the tree's rows that can be among the k best.

    Every query goes to its open leaf with the best bound, all queries of a leaf at once; whenever
    its kth score rises, boxes that allow less are closed. Equal bounds stay open, since a smaller
    id may win a tie. ``kth``: what earlier shards have passed on, NONE if nothing.
    """
    kth = kth.copy()
    bounds = open_leaves(tree, q, kth)
    order = np.argsort(~bounds, axis=1, kind="stable")
    pool = [np.zeros(0, np.int64)] * 3
    asking = np.arange(len(q))
    for turn in range(bounds.shape[1]):
        leaf = order[asking, turn]
        bound = bounds[asking, leaf]
        go = (bound >= kth[asking]) & (bound != NONE)
        asking, leaf = asking[go], leaf[go]
        if not len(asking):
            break
        found = [pool]
        by_leaf = np.argsort(leaf, kind="stable")
        for some in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
            a, b = tree["cuts"][leaf[some[0]]], tree["cuts"][leaf[some[0]] + 1]
            mine = asking[some]
            score = products(q[mine], tree["x"][a:b])
            ok = (score >= kth[mine][:, None]) & (tree["ids"][a:b][None, :] != query_id[mine][:, None])
            i, j = np.nonzero(ok)
            found.append([mine[i], tree["ids"][a:b][j], score[i, j]])
        pool = [np.concatenate(c) for c in zip(*found)]
        kept = best(*pool, k)
        pool = [c[kept] for c in pool]
        last = np.flatnonzero(np.append(np.diff(pool[0]) != 0, True)) if len(kept) else kept
        full = np.bincount(pool[0], minlength=len(q)) >= k
        last = last[full[pool[0][last]]]
        kth[pool[0][last]] = np.maximum(kth[pool[0][last]], pool[2][last])
    return tuple(pool)


# --- in Spark ---------------------------------------------------------------------------------

TREE = "ids array<bigint>, x array<double>, low array<double>, high array<double>, cuts array<bigint>"


def forest(rows: DataFrame, leaf_rows: int) -> DataFrame:
    """(dims, shard, …): one tree per shard."""

    def build(table: pa.Table) -> pa.Table:
        dims = table.column("dims")[0].as_py()
        x = matrix(table.column("v").combine_chunks()).reshape(table.num_rows, dims)
        tree = grown(table.column("vec_id").to_numpy(), np.floor(x), leaf_rows)
        flat = {c: pa.array([v.ravel()]) for c, v in tree.items()}
        return pa.table({"dims": table.column("dims").slice(0, 1), "shard": table.column("shard").slice(0, 1), **flat})

    return rows.groupBy("dims", "shard").applyInArrow(build, f"dims int, shard bigint, {TREE}")


def asked(trees: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The pairs that may be among the k best, from each query's (dims, shard, chunk)."""

    def search(held: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = {"query": [], "query_id": [], "vec_id": [], "score": []}
        if len(held) and len(ask):
            row = held.iloc[0]
            dims = int(row["dims"])
            tree = {c: np.asarray(row[c]) for c in ("ids", "x", "low", "high", "cuts")}
            shapes = {"x": len(tree["ids"]), "low": 2 * len(tree["cuts"]) - 3, "high": 2 * len(tree["cuts"]) - 3}
            tree |= {c: tree[c].astype(float).reshape(n, dims) for c, n in shapes.items()}
            q = np.floor(np.stack(ask["v"].to_numpy()).astype(float)).reshape(len(ask), dims)
            at, vec_id, score = searched(tree, ask["query"].to_numpy(), ask["query_id"].to_numpy(), q, ask["kth"].to_numpy(), k)
            out = {"query": ask["query"].to_numpy()[at], "query_id": ask["query_id"].to_numpy()[at], "vec_id": vec_id, "score": score}
        return pd.DataFrame(out)

    keys = ["dims", "shard", "chunk"]
    return trees.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(search, PAIR)


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_products(vectors: DataFrame, is_query: Column, params: KdParams = KdParams()) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products, ties to smaller vec_id.

    ``vectors``: vec_id, embedding; other columns are ignored. Queries are the rows where
    ``is_query`` (a condition on vec_id); they meet all rows of the same number of components but those with their own
    vec_id, and get all if these are fewer than k. Rows that repeat a vec_id are separate candidates
    and separate queries. See ``integer_vectors`` for rows that take no part; scores beyond 64 bits
    are held at the ends.

    Rows are dealt evenly over shards, whatever their values, so copies of one vector never meet in
    one place. A query first searches one shard; its kth score there closes boxes of the next
    ``widen`` times as many shards, and so on until all have been searched. In a wave a shard is sent
    once per chunk of queries, so a task holds one shard and one chunk.
    """
    rows = cut_lineage(integer_vectors(vectors, params.scale))
    counts = cut_lineage(rows.groupBy("dims").agg(F.count("*").alias("n"), F.count_if(is_query).alias("queries")))
    numbers = F.greatest("dims", F.lit(1))
    sized = counts.select(
        "dims",
        F.ceil(F.col("n") * numbers / params.shard_numbers).alias("shards"),
        F.greatest(F.ceil(F.col("queries") * numbers / params.chunk_numbers), F.lit(1)).alias("chunks"),
    )
    most = sized.agg(F.max("shards")).first()[0]  # one number
    placed = rows.join(sized, "dims").withColumn("shard", F.pmod(F.xxhash64("row"), "shards"))
    trees = cut_lineage(forest(placed.select("dims", "shard", "vec_id", "v"), params.leaf_rows).join(sized, "dims"))
    queries = cut_lineage(
        placed.where(is_query).select(
            F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "dims", "shard", "shards", "v",
            F.pmod(F.xxhash64("row", F.lit(1)), "chunks").alias("chunk"),
        )
    )
    chunks = trees.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    found, done = None, 0
    while most is not None and done < most:
        upto = max(1, done * params.widen)
        ask = queries if found is None else queries.join(
            found.where(F.col("rank") == params.k).select("query", F.col("score").alias("kth")), "query", "left"
        )
        known = F.lit(NONE) if found is None else F.coalesce("kth", F.lit(NONE))
        # the shards from the query's own one on that no wave has searched
        steps = F.sequence(F.lit(done).cast("long"), F.least(F.lit(upto).cast("long"), "shards") - 1)
        ask = ask.where(F.col("shards") > done).select(
            "query", "query_id", "dims", "v", "chunk", known.alias("kth"), "shard", "shards", F.explode(steps).alias("step")
        ).withColumn("shard", F.pmod(F.col("shard") + F.col("step"), "shards")).drop("step", "shards")
        pairs = asked(chunks, ask, params.k)
        found = cut_lineage(ranked(pairs if found is None else pairs.union(found.drop("rank")), params.k))
        done = upto
    if found is None:
        found = rows.sparkSession.createDataFrame([], f"{PAIR}, rank int")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
