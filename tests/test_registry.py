"""Registered queries against their SQL on the smallest test tables."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
NAMES = ["scan_filter_project", "fill_sentinel", "lookup_chain", "runs_global", "unified_period", "occasion_number",
         "asof_release", "panel_theta", "last_before", "scope_gap_stats", "panel_recency", "prev_period_rates_venue",
         "trailing_year", "topk_flag", "panel_split"]


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for t in check.TABLES:
        db.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return db


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert check.compare(got, db.sql(entry.oracle_sql()[name]).df()) == "ok"


def test_panel_has_the_expected_width():
    from panelcast.plans.panel_plan import SHOW_FEATURES, feature_names

    assert len(feature_names()) == len(set(feature_names())) == 99
    assert len(feature_names()) + len(SHOW_FEATURES) - 1 + 2 == 117


def test_later_outcomes_do_not_change_earlier_rows(spark):
    """Flip what happened from some day on: no earlier row may change."""
    from panelcast.operators.history import carry_forward
    from panelcast.operators.trailing import trailing_window
    from pyspark.sql import functions as F

    base = spark.range(400).selectExpr(
        "id % 3 AS song", "id", "date_add(DATE '2020-01-01', int(id / 4)) AS d", "int(pmod(hash(id), 3) = 0) AS played"
    )
    cut = "2020-03-01"
    flipped = base.withColumn("played", F.when(F.col("d") >= cut, 1 - F.col("played")).otherwise(F.col("played")))

    def features(df):
        own = df.withColumn("own", F.when(F.col("played") == 1, F.col("d")))
        past = carry_forward(own, "own", ["song"], "d", "id", "past").drop("own")
        out = trailing_window(past, "song", "d", {"n": ("sum", "played")}).drop("played")
        return sorted(map(tuple, out.where(F.col("d") <= cut).where("id <= 240").collect()))

    assert features(base) == features(flipped)


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_loads_without_the_training_data_operators(tmp_path, pipeline):
    root = os.path.dirname(entry.__file__)
    shutil.copytree(f"{root}/panelcast", tmp_path / "panelcast", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", "corpus_pipeline.py"][: 1 + pipeline]:
        if os.path.exists(f"{root}/{name}"):
            shutil.copy(f"{root}/{name}", tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert set(run.stdout.split()[-len(entry.registered.QUERIES):]) == set(entry.registered.QUERIES)
