import json
import random
import subprocess
import sys
from functools import reduce

import duckdb
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelcast.models import classifier, discriminant, forest, neighbours, resample
from panelcast.models.base import FEATURES, PROBA
from panelcast.operators import ml as M
from panelcast.params import ModelParams

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def toy(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        y = int(i % 4 == 0)
        a = round(y * 2 + rng.gauss(0, 1), 2)
        rows.append((i, i % 7, i % 3, 2000 + i % 5, y, a, rng.gauss(y, 1), 1.0, float(i % 9)))
    schema = "showid long, songid long, new_tourid long, showyear int, played int, " + ", ".join(f"{c} double" for c in COLS)
    return spark.createDataFrame(rows, schema).cache()


def vectors(df, cols=COLS):
    return VectorAssembler(inputCols=list(cols), outputCol=FEATURES).transform(df)


def table(df, *cols):
    return sorted(tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


# --- parameter rows and kept models -----------------------------------------------------------

ROWS = [
    {"rf__n_estimators": 4, "rf__max_depth": 4, "rf__min_samples_split": 60, "scaler": "standard", "fs": "variance", "sampler": "random"},
    {"gbf__n_estimators": 2, "gbf__subsample": 0.5}, {"xgbl__n_estimators": 2, "xgbl__max_depth": 2},
    {"bb__alpha": 0.5, "scaler": "standard"}, {"fs": "variance"}, {"scaler": "standard", "fs": "importance"}, {"sampler": "random"},
    {}, {"ada__n_estimators": 3}, {"knn__n_neighbors": 3, "scaler": "standard", "sampler": "random"},
]
MODELS = ["rf", "gbf", "xgbl", "bb", "gb", "lda", "lda_shrink", "qda", "ada", "knn"]


@pytest.fixture(scope="module")
def kept(spark, toy, tmp_path_factory):
    """Every model fitted from its row and saved, with its scores."""
    folder, scores = tmp_path_factory.mktemp("kept"), {}
    rows = [{"model": m, "params": json.dumps(p)} for m, p in zip(MODELS, ROWS)]
    path = str(folder / "rows.csv")
    spark.createDataFrame(rows).coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    for row in spark.read.option("header", True).option("escape", '"').csv(path).collect():
        params = ModelParams(start=2000, cut=2004).with_row(row.asDict())
        model = M.fit(toy, params)
        model.write().save(str(folder / row["model"]))
        scores[row["model"]] = table(M.score(model, toy, params), "showid", "songid", PROBA)
    return folder, scores


def test_models_from_a_table_of_rows_score_alike_in_a_new_session(spark, toy, kept, tmp_path):
    folder, scores = kept
    toy.write.parquet(str(tmp_path / "toy"))
    code = """
import json, sys
from panelcast.runtime import local_session
spark = local_session(2, "again")
from pyspark.ml import PipelineModel
from panelcast.operators import ml as M
from panelcast.params import ModelParams
toy = spark.read.parquet(sys.argv[2])
for name in sys.argv[3:]:
    found = M.score(PipelineModel.load(f"{sys.argv[1]}/{name}"), toy, ModelParams(start=2000))
    print("SCORES", json.dumps([name, sorted([*r] for r in found.select("showid", "songid", "y_pred_proba").collect())]))
"""
    run = subprocess.run([sys.executable, "-c", code, str(folder), str(tmp_path / "toy"), *MODELS], capture_output=True, text=True, check=True)
    again = dict(json.loads(line[7:]) for line in run.stdout.splitlines() if line.startswith("SCORES"))
    assert set(again) == set(MODELS)
    for name, found in again.items():
        assert [r[:2] for r in found] == [list(r[:2]) for r in scores[name]], name
        assert [r[2] for r in found] == pytest.approx([r[2] for r in scores[name]], abs=1e-9), name


def test_kept_models_rank_the_classes(toy, kept):
    truth = {(r.showid, r.songid): r.played for r in toy.collect()}
    for name, rows in kept[1].items():
        mean = [np.mean([p for a, b, p in rows if truth[a, b] == y]) for y in (0, 1)]
        assert mean[1] > mean[0] + 0.1 and all(0 <= p <= 1 for *_, p in rows), name


@pytest.mark.parametrize("row,words", [
    ({"model": "svm", "params": "{}"}, "unknown model"),
    ({"model": "rf", "params": '{"rf__n_trees": 5}'}, "unknown options of rf: n_trees"),
    ({"model": "rf", "params": '{"gbf__n_estimators": 5}'}, "unknown parameters"),
    ({"model": "rf", "params": '{"rf__n_estimators": 5.5}'}, "whole number"),
    ({"model": "lda", "params": '{"lda__shrinkage": 0.1}'}, "unknown options"),
    ({"model": "rf", "params": '{"scaler": "minmax"}'}, "unknown scaler"),
    ({"model": "rf", "params": '{"sampler": "smote"}'}, "unknown sampler"),
])
def test_what_a_row_may_not_hold(row, words):
    with pytest.raises(ValueError, match=words):
        ModelParams().with_row(row)


def test_the_selected_row_is_the_default():
    assert ModelParams().with_row(ModelParams().row) == ModelParams()


# --- drawing with replacement -----------------------------------------------------------------

def test_draws_have_exact_sizes_and_repeat(spark):
    rows = spark.range(1000).selectExpr("id", "id AS other", "int(CASE WHEN id < 30 THEN 1 WHEN id < 130 THEN 2 WHEN id < 135 THEN NULL ELSE 0 END) AS y")
    one = resample.oversample(rows, "y", ["id"], 7)
    assert one.columns == rows.columns
    assert {r.y: r["count"] for r in one.groupBy("y").count().collect()} == {0: 865, 1: 865, 2: 865}
    counts = {r.id: r["count"] for r in one.groupBy("id").count().collect()}
    assert set(counts) == {i for i in range(1000) if not 130 <= i < 135} and all(counts[i] == 1 for i in range(135, 1000))
    assert counts == {r.id: r["count"] for r in resample.oversample(rows.repartition(7), "y", ["id"], 7).groupBy("id").count().collect()}
    assert counts != {r.id: r["count"] for r in resample.oversample(rows, "y", ["id"], 8).groupBy("id").count().collect()}
    # 835 draws from 30 rows and 765 from 100: the spread of a multinomial draw, not an even one
    for first, n, draws in ((0, 30, 835), (30, 100, 765)):
        x = np.array([counts[i] - 1 for i in range(first, first + n)])
        statistic = ((x - draws / n) ** 2 / (draws / n)).sum()
        assert x.sum() == draws and n - 1 - 4 * (2 * n) ** 0.5 < statistic < n - 1 + 4 * (2 * n) ** 0.5
    assert resample.oversample(rows.where("false"), "y", ["id"], 7).count() == 0


# --- least split size -------------------------------------------------------------------------

WALK = """
WITH RECURSIVE walk AS (
  SELECT r.id AS row, treeID, 0 AS node FROM rows r, (SELECT DISTINCT treeID FROM nodes)
  UNION ALL
  SELECT w.row, w.treeID, CASE WHEN r.x[n.nodeData.split.featureIndex + 1] <= n.nodeData.split.leftCategoriesOrThreshold[1]
    THEN n.nodeData.leftChild ELSE n.nodeData.rightChild END
  FROM walk w JOIN nodes n ON w.treeID = n.treeID AND w.node = n.nodeData.id JOIN rows r ON r.id = w.row WHERE n.nodeData.leftChild >= 0
)
SELECT row, avg(n.nodeData.impurityStats[2] / (n.nodeData.impurityStats[1] + n.nodeData.impurityStats[2])) AS p
FROM walk w JOIN nodes n ON w.treeID = n.treeID AND w.node = n.nodeData.id WHERE n.nodeData.leftChild < 0 GROUP BY row ORDER BY row
"""


def test_no_node_below_the_bound_is_split(spark, toy):
    rows = vectors(toy).withColumn("played", F.col("played").cast("double"))
    grown = forest.Forest(labelCol="played", seed=3, trees=5).fit(rows)
    model = forest.Forest(labelCol="played", seed=3, trees=5, leastSplit=80).fit(rows)
    _, before = forest.node_table(grown)
    _, after = forest.node_table(model)
    nodes, full = after.toPandas(), before.toPandas()
    inner = [n for n in nodes["nodeData"] if n["leftChild"] >= 0]
    assert inner and min(n["rawCount"] for n in inner) >= 80 and len(nodes) < len(full)
    assert min(n["rawCount"] for n in full["nodeData"] if n["leftChild"] >= 0) < 80
    # what stays is what was grown: the same splits from the top
    assert [n["split"]["featureIndex"] for n in nodes["nodeData"] if n["id"] == 0] == [n["split"]["featureIndex"] for n in full["nodeData"] if n["id"] == 0]
    db = duckdb.connect()
    db.register("n", after.select("treeID", F.to_json("nodeData").alias("j")).toPandas())
    kind = """'{"id":"INT","impurityStats":["DOUBLE"],"leftChild":"INT","rightChild":"INT","split":{"featureIndex":"INT","leftCategoriesOrThreshold":["DOUBLE"]}}'"""
    db.sql(f"CREATE TABLE nodes AS SELECT treeID, from_json(j, {kind}) AS nodeData FROM n")
    db.register("r", toy.select("showid", *COLS).toPandas())
    db.sql(f"CREATE TABLE rows AS SELECT showid AS id, [{', '.join(COLS)}] AS x FROM r")
    scored = model.transform(rows).select("showid", M.vector_to_array("probability")[1].alias("p")).orderBy("showid").collect()
    assert [r.p for r in scored] == pytest.approx([p for _, p in db.sql(WALK).fetchall()], abs=1e-9)


# --- discriminants ----------------------------------------------------------------------------

def test_moments_merge_in_pairs_without_losing_digits(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3)) + 1e8
    df = spark.createDataFrame([(int(i % 2), v.tolist()) for i, v in enumerate(x)], "y long, x array<double>").repartition(20)
    found = discriminant.class_moments(df)
    for y in (0, 1):
        own = x[np.arange(500) % 2 == y] - 1e8
        assert found[y].n == 250 and found[y].mean - 1e8 == pytest.approx(own.mean(axis=0), abs=1e-6)
        assert found[y].cov == pytest.approx(np.cov(own.T, bias=True), abs=1e-6)


def posterior(x, y, at, pooled):
    """Two features, by the formulas of the normal density."""
    out = []
    for k in (0, 1):
        own = x[y == k]
        cov = np.cov(own.T) if not pooled else sum((x[y == j] - x[y == j].mean(axis=0)).T @ (x[y == j] - x[y == j].mean(axis=0)) for j in (0, 1)) / (len(x) - 2)
        z = at - own.mean(axis=0)
        out.append(np.log(len(own) / len(x)) - np.log(np.linalg.det(cov)) / 2 - (z @ np.linalg.inv(cov) * z).sum(axis=1) / 2)
    return 1 / (1 + np.exp(out[0] - out[1]))


@pytest.mark.parametrize("pooled", [True, False])
def test_discriminants_follow_the_formulas_and_ignore_collinear_columns(toy, pooled):
    model = discriminant.Discriminant("played", pooled=pooled)
    plain = [r[0] for r in model.fit(vectors(toy, "ab")).transform(vectors(toy, "ab")).orderBy("showid").select(PROBA).collect()]
    held = toy.orderBy("showid").toPandas()
    x = held[["a", "b"]].to_numpy()
    assert plain == pytest.approx(posterior(x, held["played"].to_numpy(), x, pooled), abs=1e-9)
    wide = toy.withColumns({"a2": F.col("a"), "sum": F.col("a") * 3 - F.col("b") + 5, "none": F.lit(4.0), "big": F.col("b") * 1e6})
    rows = vectors(wide, ["a", "b", "a2", "sum", "none", "big"])
    moved = [r[0] for r in model.fit(rows).transform(rows).orderBy("showid").select(PROBA).collect()]
    assert moved == pytest.approx(plain, abs=1e-6)


# --- neighbours -------------------------------------------------------------------------------

def clusters(spark, n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 50, (12, 3))
    x = centres[rng.integers(0, 12, n)] + np.round(rng.normal(0, 1, (n, 3)), 1)
    x[: n // 3] = x[0]  # a heap of equal rows
    rows = [(int(i * 7 % n), int(i % 2), v.tolist()) for i, v in enumerate(x)]
    return rows, spark.createDataFrame(rows, "id long, y long, x array<double>")


@pytest.mark.parametrize("k,block", [(1, 20), (5, 50), (7, 10_000), (400, 30)])
def test_neighbours_equal_all_pairs_and_skip_blocks(spark, k, block):
    rows, df = clusters(spark, 300, k)
    model = neighbours.Neighbours("y", ["id"], k, block).fit_on(df, F.col("x"))
    asked = df.where("id % 3 = 0").select(F.col("id").alias("__row"), "x")
    found, counts = model.searched(asked.union(spark.createDataFrame([(999, None)], "id long, x array<double>")))
    got = {}
    for r in found.collect():
        got.setdefault(r["__row"], []).append((r["d"], r["near"]["id"], r["y"]))
    want = {}
    for i, _, q in rows:
        if i % 3 == 0:
            d = sorted((reduce(lambda s, ab: s + (ab[0] - ab[1]) * (ab[0] - ab[1]), zip(x, q), 0.0), j, float(y)) for j, y, x in rows)
            want[i] = d[:k]
    assert {i: sorted(v) for i, v in got.items()} == want
    if block == 20:
        assert counts["met"] < counts["pairs"] / 2


def test_training_blocks_travel_once_for_few_rows(spark, monkeypatch):
    """However many blocks the rows to score lie in, each training block meets them in one row."""
    _, df = clusters(spark, 300, 3)
    model = neighbours.Neighbours("y", ["id"], 400, 30).fit_on(df, F.col("x"))
    met = spark.sparkContext.accumulator(0)
    own = neighbours.nearest
    monkeypatch.setattr(neighbours, "nearest", lambda *a: (met.add(1), own(*a))[1])
    found, counts = model.searched(df.where("id % 15 = 0").select(F.col("id").alias("__row"), "x"))
    assert found.count() == 20 * 300
    assert counts["met"] > 2 * model.stored.count() >= met.value > 0


def test_near_pivots_of_many_are_in_the_nearest_group():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 100, (40, 6))
    pivots = centres[rng.integers(0, 40, 1500)] + rng.normal(0, 1, (1500, 6))
    pivots[700:720] = pivots[3]
    x = pivots + rng.normal(0, 0.01, pivots.shape)
    got = neighbours.nearest_pivot(pivots)(x)
    own = np.sqrt(((pivots[got] - x) ** 2).sum(axis=1))
    best = np.sqrt(neighbours.roughly(x, pivots).min(axis=1))
    assert (got < 1500).all() and np.isclose(own, best, atol=1e-4).mean() > 0.9
    assert (neighbours.nearest_pivot(pivots[:200])(x) == neighbours.roughly(x, pivots[:200]).argmin(axis=1)).all()


def test_votes_keep_columns_and_rows_without_features(spark):
    train = spark.createDataFrame([(1, 1, [0.0]), (2, 0, [9.0]), (3, None, [0.0]), (None, 1, [0.0])], "id long, y long, x array<double>")
    test = spark.createDataFrame([("n", [1.0]), ("m", None)], "name string, x array<double>")
    model = neighbours.Neighbours("y", ["id"], 1).fit_on(train, F.col("x"))
    assert sorted(map(tuple, model.voted(test, F.col("x")).select("name", PROBA).collect())) == [("m", None), ("n", 1.0)]
    none = neighbours.Neighbours("y", ["id"], 1).fit_on(train.where("false"), F.col("x"))
    assert [r[2] for r in none.voted(test, F.col("x")).collect()] == [None, None]
