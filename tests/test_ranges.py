import random

import pytest
from pyspark.sql import functions as F

from panelcast.operators import ranges


def plain(rows):
    out, before, last = [], None, None
    for i, (day, key, v) in enumerate(sorted(rows)):
        last = v if v is not None else last
        out.append((key, i + 5, before, last))
        before = v
    return sorted(out)


@pytest.mark.parametrize("n,parts", [(500, 7), (3, 8), (1, 2)])
def test_hashed_ids_need_no_common_task(spark, n, parts):
    rng = random.Random(n)
    rows = [(rng.randrange(6), rng.getrandbits(62) - (1 << 61), rng.choice([None, None, rng.randrange(99)])) for _ in range(n)]
    df = spark.createDataFrame(rows, "day int, id long, v int").repartition(3)
    out = ranges.running(df, ["day", "id"], {"number": 5}, {"before": "v"}, {"last": "v"}, parts)
    assert out.columns == ["day", "id", "v", "number", "before", "last"]
    assert sorted(tuple(r) for r in out.select("id", "number", "before", "last").collect()) == plain(rows)
    if n == 500:
        sizes = [r["count"] for r in ranges.ranged(df, ["day", "id"], parts).groupBy(ranges.RANGE).count().collect()]
        assert len(sizes) == parts and max(sizes) < 2 * n / parts


def test_empty_ranges_ties_and_a_column_filled_in_place(spark):
    df = spark.range(0).selectExpr("id", "int(id) AS v")
    assert ranges.running(df, ["id"], {"n": 0}, {"b": "v"}, {"v": "v"}).collect() == []
    one = spark.createDataFrame([(1, None), (2, 4), (2, 4), (3, None), (None, 9)], "id long, v int")
    out = ranges.running(one, ["id"], {"n": 0}, fills={"v": "v"}, ranges=4)
    assert sorted(tuple(r) for r in out.select("n", "v").collect()) == [(0, 9), (1, 9), (2, 4), (3, 4), (4, 4)]


def test_only_one_row_per_range_meets_in_one_task(spark):
    df = spark.range(100).select(F.xxhash64("id").alias("id"), F.col("id").alias("v"))
    plan = ranges.running(df, ["id"], {"n": 0}, ranges=4)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan  # the carried rows are stored before the rows are read
