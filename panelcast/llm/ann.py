"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.runtime import cut_lineage


@dataclass(frozen=True)
class TreeParams:
    sample_rows: int = 32_768  # about as many vectors shape the tree; every vector is put into it
    branch: int = 8
    leaf_rows: int = 64  # of the sample
    rounds: int = 8
    block_rows: int = 4096  # leaves are searched in groups of about this many vectors, larger ones in blocks of as many
    k: int = 10
    recall: float = 0.95  # on the calibration queries
    calibration: int = 100  # about as many queries are compared with all vectors
    seed: int = 3


@dataclass
class Tree:
    centres: np.ndarray  # nodes × dims; the root's is not used
    children: list[list[int]]  # none for leaves

    @property
    def leaves(self) -> list[int]:
        return [i for i, c in enumerate(self.children) if not c]


def valid_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, v) as doubles of the vectors that take part.

    Null vectors, those holding null or non-finite components, and zero vectors do not; nor do rows
    without vec_id, and vectors of another length than most (the longer one of a tie).
    """
    number = F.transform("embedding", lambda x: x.cast("double"))
    clean = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    out = rows.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long"), number.alias("v")).where(F.col("v").isNotNull() & clean)
    sizes = out.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return out.where(F.size("v") == (sizes["n"] if sizes else -1))


def matrix(column) -> np.ndarray:
    """A list column as a matrix of doubles."""
    rows = len(column)
    flat = pa.array(column).flatten() if not isinstance(column, pa.Array) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1) if rows else np.zeros((0, 0))


def grown(sample: np.ndarray, params: TreeParams) -> Tree:
    """k-means with ``branch`` centres, again inside each cluster, until few rows are left or they are equal."""
    rng = np.random.default_rng(params.seed)
    tree = Tree(np.zeros((1, sample.shape[1])), [[]])
    centres, todo = [np.zeros(sample.shape[1])], [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= params.leaf_rows:
            continue
        x = sample[rows]
        c = x[rng.choice(len(x), min(params.branch, len(x)), replace=False)]
        for _ in range(params.rounds):
            own = nearest(x, c)
            c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        own = nearest(x, c)
        filled = np.unique(own)
        if len(filled) < 2:
            continue
        for j in filled:
            tree.children[node].append(len(centres))
            tree.children.append([])
            todo.append((len(centres), rows[own == j]))
            centres.append(c[j])
    tree.centres = np.array(centres)
    return tree


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row, going down to the nearest child."""
    at = np.zeros(len(x), int)
    open_ = np.arange(len(x)) if tree.children[0] else np.zeros(0, int)
    while len(open_):
        for node in np.unique(at[open_]):
            rows = open_[at[open_] == node]
            at[rows] = np.array(tree.children[node])[nearest(x[rows], tree.centres[tree.children[node]])]
        open_ = open_[[bool(tree.children[i]) for i in at[open_]]]
    return at


def visits(tree: Tree, q: np.ndarray, most: int, rows_of: np.ndarray, least_rows: int) -> list[int]:
    """Leaves in the order of a best-bin-first search: at least ``most``, and ``least_rows`` rows.

    The queue holds the children passed by on the way down, by their distance to the query.
    """
    queue, out, rows = [(0.0, 0)], [], 0
    while queue and (len(out) < most or rows < least_rows):
        node = heapq.heappop(queue)[1]
        while tree.children[node]:
            kids = tree.children[node]
            far = ((tree.centres[kids] - q) ** 2).sum(axis=1)
            order = np.argsort(far, kind="stable")
            for j in order[1:]:
                heapq.heappush(queue, (float(far[j]), kids[j]))
            node = kids[order[0]]
        out.append(node)
        rows += int(rows_of[node])
    return out


def distances(z: np.ndarray) -> np.ndarray:
    """Lengths of the rows; squares that overflow are scaled first."""
    with np.errstate(over="ignore"):
        out = np.sqrt((z**2).sum(axis=1))
    far = ~np.isfinite(out)
    if far.any():
        most = np.abs(z[far]).max(axis=1, keepdims=True)
        out[far] = most[:, 0] * np.sqrt(((z[far] / most) ** 2).sum(axis=1))
    return out


def closest(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's k nearest of these vectors but itself, by exact distance, ties to smaller ids.

    Products preselect: what lies within rounding of the k-th squared distance is measured exactly.
    """
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    step = max(1, (1 << 21) // max(1, len(x)))
    with np.errstate(over="ignore", invalid="ignore"):
        xx, qq = (x**2).sum(axis=1), (q**2).sum(axis=1)
    for a in range(0, len(q) if len(x) else 0, step):
        part = q[a : a + step]
        other = ids[None, :] != query_ids[a : a + step, None]
        with np.errstate(over="ignore", invalid="ignore"):
            rough = xx[None, :] + qq[a : a + step, None] - 2 * part @ x.T
        near = other
        if len(x) > k and np.isfinite(rough).all():
            rough[~other] = np.inf
            off = 1e-12 * (xx.max() + qq[a : a + step].max())
            near = other & (rough <= np.partition(rough, k - 1, axis=1)[:, k - 1 : k] + 2 * off)
        i, j = np.nonzero(near)
        far = np.concatenate([distances(x[j[c : c + (1 << 16)]] - part[i[c : c + (1 << 16)]]) for c in range(0, len(i), 1 << 16)] or [np.zeros(0)])
        order = np.lexsort((ids[j], far, i))
        query = i[order]
        kept = order[np.arange(len(order)) - np.searchsorted(query, query) < k]
        found.append((query_ids[a + i[kept]], ids[j[kept]], far[kept]))
    query, vec, far = (np.concatenate(c) for c in zip(*found))
    return pd.DataFrame({"query_id": query, "vec_id": vec, "score": far})


FIRST = 16  # visits before distances are passed on
PAIR = "query_id long, vec_id long, score double"


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query: Spark cuts to k before the shuffle and after."""
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def brute_force(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """(query_id, vec_id, score, rank) of a few queries against all rows, in blocks of rows."""
    ids, q = np.array([i for i, _ in queries]), np.array([v for _, v in queries], float)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = closest(batch.column(0).to_numpy(), matrix(batch.column(1)), ids, q, k)
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    return ranked(vectors.mapInArrow(run, PAIR), k)


def indexed(vectors: DataFrame, tree: Tree) -> DataFrame:
    """(leaf, vec_id, v): every vector in its leaf."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = leaf_of(tree, matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column(0), batch.column(1)], ["leaf", "vec_id", "v"])

    return vectors.mapInArrow(run, "leaf long, vec_id long, v array<double>")


def grouped(tree: Tree, rows_of: np.ndarray, block_rows: int) -> np.ndarray:
    """The group of each leaf, -1 for other nodes: leaves that follow each other in the tree are searched
    together while they have at most ``block_rows`` rows. The order is that of a walk over the tree, so a
    group's leaves are near each other."""
    out, group, held, todo = np.full(len(tree.children), -1), 0, 0, [0]
    while todo:
        node = todo.pop()
        todo += reversed(tree.children[node])
        if not tree.children[node]:
            if held and held + rows_of[node] > block_rows:
                group, held = group + 1, 0
            out[node], held = group, held + int(rows_of[node])
    return out


def asked(queries: DataFrame, tree: Tree, rows_of: np.ndarray, group_of: np.ndarray, blocks: np.ndarray, most: int, least_rows: int, later: bool) -> DataFrame:
    """(leaf_group, block, query_id, q): each query once for every block of the groups it visits.

    These are the groups of its first visits or, ``later``, of all others up to ``most`` leaves.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for i, q in zip(batch.column(0).to_pylist(), matrix(batch.column(1))):
                met = list(dict.fromkeys(group_of[visits(tree, q, most, rows_of, least_rows)].tolist()))
                near = list(dict.fromkeys(group_of[visits(tree, q, min(most, FIRST), rows_of, least_rows)].tolist()))
                rows += [(g, b, i, q) for g in (met if later else near) if not later or g not in near for b in range(blocks[g])]
            if rows:
                group, block, ids, q = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group), pa.array(block), pa.array(ids), pa.array(list(q), pa.list_(pa.float64()))],
                    ["leaf_group", "block", "query_id", "q"],
                )

    return queries.select("vec_id", "v").mapInArrow(run, "leaf_group long, block long, query_id long, q array<double>")


def searched(index: DataFrame, queries: DataFrame, tree: Tree, rows_of: np.ndarray, most: int, params: TreeParams) -> DataFrame:
    """The k nearest found in the groups of the leaves that each query visits.

    A group's vectors are dealt over blocks by their id, and a query goes once to every block of its
    groups, so neither a common vector nor a common leaf is one task.
    """
    group_of = grouped(tree, rows_of, params.block_rows)
    held_by = np.bincount(group_of[tree.leaves], rows_of[tree.leaves]).astype(int)
    blocks = -(-held_by // params.block_rows)  # none for a group without vectors
    placed = [(int(i), int(group_of[i]), max(1, int(blocks[group_of[i]]))) for i in tree.leaves]
    groups = index.sparkSession.createDataFrame(placed, "leaf long, leaf_group long, blocks long")
    held = index.join(F.broadcast(groups), "leaf").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))

    def compared(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = closest(x["vec_id"].to_numpy(), np.stack(x["v"]), q["query_id"].to_numpy(), np.stack(q["q"]), params.k)
        limit = q.groupby("query_id")["worst"].max()
        return found[found["score"].to_numpy() <= limit.loc[found["query_id"]].to_numpy()]

    def pairs(asking: DataFrame) -> DataFrame:
        return held.groupBy("leaf_group", "block").cogroup(asking.groupBy("leaf_group", "block")).applyInPandas(compared, PAIR)

    def asks(later: bool) -> DataFrame:
        return asked(queries, tree, rows_of, group_of, blocks, most, params.k + 1, later)

    # the first visits give a k-th distance, beyond which the others return nothing
    near = cut_lineage(ranked(pairs(asks(False).withColumn("worst", F.lit(float("inf")))), params.k))
    kth = near.where(F.col("rank") == params.k).select("query_id", F.col("score").alias("kth"))
    rest = asks(True).join(kth, "query_id", "left")
    rest = rest.select("leaf_group", "block", "query_id", "q", F.coalesce("kth", F.lit(float("inf"))).alias("worst"))
    return ranked(near.drop("rank").union(pairs(rest)), params.k)


def nearest_neighbours(vectors: DataFrame, is_query, params: TreeParams = TreeParams()) -> tuple[DataFrame, dict]:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (vec_id, embedding, …) where ``is_query``.

    Also returned: the leaves visited and the recall measured for them. The tree is fitted on a
    bounded sample, and a visit of a leaf searches the group it is in; leaf visits double until the calibration queries, compared with all rows, reach
    ``recall``, at worst until all leaves are visited. Fewer than k candidates are returned all. A
    vec_id that occurs twice is two candidates, and never its own query's. See ``valid_vectors``.
    """
    rows = cut_lineage(valid_vectors(vectors))
    spark, total = rows.sparkSession, rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double"), {"leaves": 0, "recall": 1.0}

    def some(df: DataFrame, n: int, of: int, salt: int) -> list:
        drawn = F.pmod(F.xxhash64(F.col("vec_id"), F.lit(salt)), F.lit(1 << 30)) < int(min(1.0, n / max(of, 1)) * (1 << 30))
        return sorted(df.where(drawn).toArrow().to_pylist(), key=lambda r: r["vec_id"])

    sample = np.array([r["v"] for r in some(rows, params.sample_rows, total, params.seed)], float)
    tree = grown(sample, params) if len(sample) else Tree(np.zeros((1, 1)), [[]])
    index = cut_lineage(indexed(rows, tree))
    rows_of = np.zeros(len(tree.children), int)
    for r in index.groupBy("leaf").count().collect():  # one number per leaf of a bounded tree
        rows_of[r["leaf"]] = r["count"]
    queries = rows.where(is_query)
    tried = [(r["vec_id"], r["v"]) for r in some(queries, params.calibration, queries.count(), params.seed + 1)]
    most, recall, group_of = 1, 1.0, grouped(tree, rows_of, params.block_rows)
    if tried:
        want = {(r["query_id"], r["vec_id"]) for r in brute_force(rows, tried, params.k).collect()}
        leaf_of_id = {r["vec_id"]: r["leaf"] for r in index.where(F.col("vec_id").isin([v for _, v in want])).select("vec_id", "leaf").collect()}
        order = {i: visits(tree, np.array(q, float), len(tree.leaves), rows_of, 0) for i, q in tried}
        while True:
            seen = {i: set(group_of[o[:most]].tolist()) for i, o in order.items()}
            recall = sum(int(group_of[leaf_of_id[v]]) in seen[i] for i, v in want) / max(len(want), 1)
            if recall >= params.recall or most >= len(tree.leaves):
                break
            most = min(most * 2, len(tree.leaves))
    out = searched(index, queries, tree, rows_of, most, params)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), {"leaves": most, "recall": recall}
