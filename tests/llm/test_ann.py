import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import ann
from panelcast.llm.ann import TreeParams

ROWS = "vec_id long, embedding array<float>, label int, v int, leaf string"
SMALL = TreeParams(sample_rows=400, leaf_rows=12, branch=4, block_rows=30, k=5)


def brute(rows, query, k):
    ok = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 6}
    out = {}
    for q in filter(query, ok):
        far = sorted((float(np.sqrt(((x - ok[q]) ** 2).sum())), i) for i, x in ok.items() if i != q)
        out[q] = far[:k]
    return out


def run(spark, rows, query, params=SMALL):
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], ROWS).repartition(3)
    out, facts = ann.nearest_neighbours(df, query, params)
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    return got, facts


def clustered(n, seed=0):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(9, 6))
    return [(i, (centres[i % 9] + 0.3 * g.normal(size=6)).tolist()) for i in range(n)]


def test_recall_and_exact_distances(spark):
    rows = clustered(900)
    want = brute(rows, lambda i: i % 10 == 0, 5)
    got, facts = run(spark, rows, F.col("vec_id") % 10 == 0)
    assert set(got) == set(want) and facts["recall"] >= 0.95
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    scores = dict((q, dict((i, s) for s, i in v)) for q, v in want.items())
    for q, found in got.items():
        assert found == sorted(found) and len(found) == 5
        assert all(s == pytest.approx(scores[q][i], abs=1e-12) for s, i in found if i in scores[q])


def test_all_leaves_give_the_exact_answer_with_ties_and_odd_rows(spark):
    rows = clustered(120, 1) + [(1000 + i, [1.0] * 6) for i in range(100)]
    rows += [(2000, None), (2010, []), (2020, [0.0] * 6), (2030, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2040, [float("nan")] * 6), (2050, [float("inf")] * 6), (2060, [1.0] * 5), (None, [1.0] * 6)]
    exact = TreeParams(sample_rows=400, leaf_rows=12, branch=4, block_rows=30, k=5, recall=1.1)
    got, facts = run(spark, rows, F.col("vec_id") % 10 == 0, exact)
    want = brute(rows, lambda i: i % 10 == 0, 5)
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
    assert facts["leaves"] > 5


def test_few_rows_and_none(spark):
    got, _ = run(spark, [(0, [1.0] * 6), (10, [2.0] * 6), (3, [3.0] * 6)], F.col("vec_id") % 10 == 0)
    assert {q: [i for _, i in v] for q, v in got.items()} == {0: [10, 3], 10: [0, 3]}
    assert run(spark, [(0, [1.0] * 6)], F.lit(True))[0] == {} and run(spark, [], F.lit(True))[0] == {}


def test_search_goes_on_until_it_has_enough_rows(spark):
    got, _ = run(spark, clustered(300, 2), F.col("vec_id") < 3, TreeParams(sample_rows=300, leaf_rows=2, branch=4, k=40, recall=0.0))
    assert all(len(v) == 40 for v in got.values())


def test_visits_are_best_bin_first():
    x = np.array([v for _, v in clustered(400, 5)])
    tree = ann.grown(x, SMALL)
    rows = np.ones(len(tree.children), int)
    order = ann.visits(tree, x[0], 10**6, rows, 0)
    assert sorted(order) == tree.leaves and order[0] == ann.leaf_of(tree, x[:1])[0]


def test_vectors_whose_squares_overflow_are_found(spark):
    rows = [(0, [1e200, 0.0]), (1, [0.0, 1e200]), (2, [3e200, 4e200]), (100, [-1e200, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in ann.nearest_neighbours(df, F.col("vec_id") == 0)[0].collect()}
    assert got == pytest.approx({(0, 1): 2**0.5 * 1e200, (0, 2): 20**0.5 * 1e200, (0, 100): 2e200})


def test_a_query_meets_groups_of_leaves_not_each_leaf(spark):
    x = np.array([v for _, v in clustered(800, 6)])
    tree = ann.grown(x, SMALL)
    rows_of = np.bincount(ann.leaf_of(tree, x), minlength=len(tree.children))
    group_of = ann.grouped(tree, rows_of, 200)
    held = np.bincount(group_of[tree.leaves], rows_of[tree.leaves])
    assert len(tree.leaves) > 60 and held.sum() == 800 and held.max() <= 200 and len(held) <= 8
    assert (group_of >= 0).sum() == len(tree.leaves)
    queries = spark.createDataFrame([(i, x[i].tolist()) for i in range(20)], "vec_id long, v array<double>")
    blocks = np.ones(len(held), int)
    met = [ann.asked(queries, tree, rows_of, group_of, blocks, len(tree.leaves), 6, later).select("query_id", "leaf_group").collect() for later in (False, True)]
    assert sorted(map(tuple, met[0] + met[1])) == [(i, g) for i in range(20) for g in range(len(held))]
