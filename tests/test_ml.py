import json
import random

import pytest

from panelcast.operators import ml as M
from panelcast.params import ModelParams


@pytest.fixture(scope="module")
def toy(spark):
    rng = random.Random(1)
    rows = []
    for i in range(240):
        y = int(i % 4 == 0)
        rows.append((i, i % 7, i % 3, 2000 + i % 5, y, y * 4 + rng.random(), rng.gauss(y * 3, 1), 1.0))
    return spark.createDataFrame(
        rows, "showid long, songid long, new_tourid long, showyear int, played int, a double, b double, c double"
    ).cache()


@pytest.mark.parametrize("model,options", [
    ("rf", {"n_estimators": 5, "max_depth": 4}), ("gbf", {"n_estimators": 3}), ("bb", {}), ("gb", {}), ("lda", {}),
    ("lda_shrink", {}), ("qda", {}), ("ada", {"n_estimators": 3}), ("knn", {"n_neighbors": 3}),
])
def test_models_rank_a_separable_set(toy, model, options):
    params = ModelParams(start=2000, cut=2004, model=model, options=options)
    scores = {(r.showid, r.songid): r.y_pred_proba for r in M.fit_and_score(toy, toy, params).collect()}
    truth = {(r.showid, r.songid): r.played for r in toy.collect()}
    assert len(scores) == len(truth) and all(0 <= p <= 1 for p in scores.values())
    mean = [sum(scores[k] for k in truth if truth[k] == y) / sum(truth[k] == y for k in truth) for y in (0, 1)]
    assert mean[1] > mean[0] + 0.3


def test_oversample_balances_and_keeps_all(toy):
    out = M.oversample(toy, "played", ["showid", "songid"], 1994)
    counts = {r.played: r["count"] for r in out.groupBy("played").count().collect()}
    assert counts == {0: 180, 1: 180}
    assert out.distinct().count() == toy.count()


def test_training_choice(toy):
    def years(**kw):
        rows = M.select_training(toy, ModelParams(start=2001, cut=2004, last_groups=2, **kw))
        return sorted(r.showyear for r in rows.select("showyear").distinct().collect())

    assert years() == [2001, 2002, 2003, 2004]
    assert years(refit=False) == [2001, 2002, 2003]
    assert years(cv_type="sliding") == [2003, 2004]
    assert years(cv_type="sliding", refit=False) == [2002, 2003]


def test_scaling_and_constant_columns(toy):
    scaled, _ = M.standardise(toy, [toy], ["a", "c"])
    row = scaled.selectExpr("avg(a)", "stddev_pop(a)", "max(c)").first()
    assert row[0] == pytest.approx(0) and row[1] == pytest.approx(1) and row[2] == 0
    assert M.variance_select(toy, ["a", "b", "c"]) == ["a", "b"]


def test_parse_params():
    row = {"model": "rf", "params": json.dumps({"rf__n_estimators": 5, "fs": "variance", "scaler": "standard"})}
    assert M.parse_params(row) == ("rf", {"n_estimators": 5}, {"scaler": "standard", "fs": "variance", "sampler": None})


def test_report(spark):
    scores = spark.createDataFrame([(1, 9, 0.7), (2, 9, 0.4), (3, 9, 0.9)], "songid long, showid long, y_pred_proba double")
    songs = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b"), (3, "c")], "songid long, song string")
    shows = spark.sql("SELECT 9L AS showid, 'v' AS venue, 'c' AS city, 's' AS state, 'u' AS country, DATE '2025-07-25' AS showdate")
    rows = M.score_report(scores, songs, shows).collect()
    assert [(r.song, r.showdate) for r in rows] == [("c", "07/25/2025"), ("a", "07/25/2025")]
    assert M.score_report(scores, songs, shows, top=3).count() == 3
