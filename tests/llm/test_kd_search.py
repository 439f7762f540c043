import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import kd_search as kd

VECTORS = "vec_id long, embedding array<float>, label int"
QUERY = "vec_id % 5 = 0"


def brute(rows, k, scale=64):
    whole = []
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.append((i, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    out = []
    for i, q in whole:
        if i % 5 == 0:
            near = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near[:k])]
    return sorted(out)


def vectors(seed, n, dims):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(9)]
    rows = [(i, [x + rng.choice([0, 0.02]) for x in rng.choice(base)], 0) for i in range(n)]
    return rows + [(n + i, base[0], 0) for i in range(n)]  # one vector is half of all rows


def found(spark, rows, **kw):
    out = kd.top_products(spark.createDataFrame(rows, VECTORS), F.expr(QUERY), kd.KdParams(**kw))
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("dims,kw", [
    (3, {"k": 4}),
    (6, {"k": 7, "shard_numbers": 120, "chunk_numbers": 30, "leaf_rows": 3, "widen": 2}),
])
def test_results_equal_brute_force(spark, dims, kw):
    rows = vectors(dims, 60, dims)
    assert found(spark, rows, **kw) == brute(rows, kw["k"])


def test_rows_that_take_no_part_lengths_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (5, [nan, 1.0], 1), (10, [inf, 1.0], 1), (15, None, 1), (20, [None, 1.0], 1), (None, [1.0, 1.0], 1),
            (25, [0.0, 0.0], 1), (1, [-1.0, 0.5], 1), (2, [1.0], 1), (30, [2.0], 1), (35, [], 1), (36, [], 1), (3, [1.0, 2.0], 1),
            (3, [1.0, 2.0], 1), (40, [1.0, 1.0, 1.0], 1)]
    assert found(spark, rows, k=20) == brute(rows, 20)
    assert (30, 1, 2, 64 * 128) in found(spark, rows, k=20) and (35, 1, 36, 0) in found(spark, rows, k=20)


def test_empty_table_and_clashing_names(spark):
    schema = VECTORS + ", row long, v string, dims int, shard int, query int, score int"
    assert kd.top_products(spark.createDataFrame([], schema), F.expr(QUERY)).collect() == []
    rows = [(0, [1.0], 1, 2, "v", 3, 4, 5, 6), (1, [2.0], 1, 2, "v", 3, 4, 5, 6)]
    assert [tuple(r) for r in kd.top_products(spark.createDataFrame(rows, schema), F.expr(QUERY)).collect()] == [(0, 1, 1, 8192)]


def test_large_components_stay_exact():
    rng = np.random.default_rng(1)
    a, b = (np.floor(rng.normal(0, 2.0**28, (5, 7))) for _ in range(2))
    exact = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
    assert kd.products(a, b).tolist() == exact
    top = np.iinfo(np.int64).max
    assert kd.products(np.array([[1e200]]), np.array([[1e100], [-1e100]])).tolist() == [[top, -top - 1]]


def test_boxes_close_leaves_and_bound_their_rows():
    rng = np.random.default_rng(2)
    x = np.floor(np.concatenate([rng.normal(c, 4, (400, 2)) for c in ((-400, 0), (400, 0), (0, 400), (0, -400))]))
    tree = kd.grown(np.arange(len(x)), x, 25)
    assert sorted(tree["ids"]) == list(range(len(x))) and (x[tree["ids"]] == tree["x"]).all()
    q = np.floor(rng.normal(0, 50, (40, 2)))
    bounds = kd.open_leaves(tree, q, np.full(len(q), kd.NONE))
    for j, (a, b) in enumerate(zip(tree["cuts"], tree["cuts"][1:])):
        assert 0 < b - a <= 25 and (kd.products(q, tree["x"][a:b]).max(axis=1) <= bounds[:, j]).all()
    kth = np.sort(kd.products(q, x), axis=1)[:, -10]
    assert (kd.open_leaves(tree, q, kth) != kd.NONE).mean() < 0.3


def test_best_keeps_ties_with_smaller_ids():
    query, ids, score = np.array([1, 0, 1, 1, 0]), np.array([9, 4, 3, 7, 2]), np.array([5, 1, 5, 6, 1])
    assert ids[kd.best(query, ids, score, 2)].tolist() == [2, 4, 7, 3]
