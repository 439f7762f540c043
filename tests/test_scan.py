import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcast.operators import scan as S

SCHEMA = "k string, d date, id long, v long"
VALUES = {
    "idx": S.running_index(), "total": S.running_sum("v"), "low": S.running_min("v"), "high": S.running_max("v"),
    "back": S.lag("v"), "ahead": S.lead("v"), "past": S.last_before("v"), "filled": S.fill_forward("v"),
}


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(7)
    keys = ["hot"] * 4 + ["a", "b", "c", None]  # one key holds half of the rows
    rows = [
        (rng.choice(keys), date(2019, 12, 1) + timedelta(days=min(rng.randrange(400), 300)), i,
         rng.choice([None, rng.randrange(9)]))
        for i in range(1500)  # and a quarter of them fall on one day
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


def plain(df):
    w = Window.partitionBy("k").orderBy("d", "id")
    past, now = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    return df.where("k IS NOT NULL").select(
        "*", (F.row_number().over(w) - 1).cast("long").alias("idx"), F.sum("v").over(now).alias("total"),
        F.min("v").over(now).alias("low"), F.max("v").over(now).alias("high"), F.lag("v").over(w).alias("back"),
        F.lead("v").over(w).alias("ahead"), F.last("v", True).over(past).alias("past"),
        F.last("v", True).over(now).alias("filled"),
    )


def same(a, b):
    return sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("options", [{"block_bits": 4}, {"block_bits": None}, {"grain": "month"}, {"grain": "year"}])
def test_scan_equals_plain_windows(history, options):
    out = S.scan(history, (S.by_day(["k"], "d", "id", **options), VALUES))
    assert same(out.where("k IS NOT NULL"), plain(history))
    lost = out.where("k IS NULL")
    assert lost.count() == history.where("k IS NULL").count()
    assert lost.where("idx IS NOT NULL OR past IS NOT NULL OR total IS NOT NULL").count() == 0


def test_scan_without_keys_and_by_id(history):
    w = Window.orderBy("id")
    out = S.scan(history, (S.by_id((), "id", block_bits=5), {"n": S.running_index(1), "before": S.last_before("v")}))
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    assert same(out, history.select("*", F.row_number().over(w).cast("long").alias("n"), F.last("v", True).over(past).alias("before")))


@pytest.mark.parametrize("chunk_rows,few", [(5, 1000), (64, 1000), (10_000, 0), (20, 0)])
def test_expanding_stats_equal_growing_frames(history, monkeypatch, chunk_rows, few):
    monkeypatch.setattr(S._chunk_start, "__defaults__", (few,))
    at = S.scan(history, (S.by_day(["k"], "d", "id"), {"idx": S.running_index()}))
    one = S.Expanding("v", ("k",), ("d", "id"), F.col("idx"), {"min": "lo", "max": "hi", "avg": "av", "median": "med"})
    out = S.expanding_stats(at, one, chunk_rows=chunk_rows).where("k IS NOT NULL")
    now = Window.partitionBy("k").orderBy("d", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = at.where("k IS NOT NULL").select(
        "*", F.min("v").over(now).alias("lo"), F.max("v").over(now).alias("hi"), F.avg("v").over(now).alias("av"),
        F.percentile("v", F.lit(0.5)).over(now).alias("med"),
    )
    assert same(out, expected)


def test_expanding_stats_of_doubles(spark):
    rng = random.Random(3)
    rows = [(1, i, rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, idx long, v double")
    one = S.Expanding("v", ("k",), ("idx",), F.col("idx"), {"median": "med", "max": "hi"})
    got = {r.idx: (r.med, r.hi) for r in S.expanding_stats(df, one, chunk_rows=16).collect()}
    import statistics

    for i in range(300):
        so_far = [v for _, _, v in rows[: i + 1]]
        assert got[i][0] == pytest.approx(statistics.median(so_far)) and got[i][1] == max(so_far)


@pytest.mark.parametrize("kind", ["unique", "sorted", "ties"])
def test_medians_of_long_histories_take_rows_in_proportion(spark, kind):
    rng = random.Random(4)
    n, chunk = 4000, 16  # 250 chunks of one key
    v = {"unique": lambda i: rng.random(), "sorted": lambda i: -i / 7, "ties": lambda i: float(rng.choice([1, 1, 1, 5, i]))}[kind]
    rows = [("a", i, None if i % 50 == 3 else v(i)) for i in range(n)] + [("b", i, 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, idx long, v double").repartition(4)
    start = S._start_by_ranges(df.select("k", "v", F.floor(F.col("idx") / chunk).alias("__chunk")), "v", ["k"], chunk)
    # each chunk's frame: the values its medians can reach and what shares their ranges
    sizes = {r["__chunk"]: r["count"] for r in start.where("k = 'a'").groupBy("__chunk").count().collect()}
    assert len(sizes) == n // chunk - 1 and max(sizes.values()) < 6 * chunk + 2 and sum(sizes.values()) < 4 * n
    one = S.Expanding("v", ("k",), ("idx",), F.col("idx"), {"median": "med", "avg": "av", "min": "lo", "max": "hi"})
    with pytest.MonkeyPatch.context() as m:
        m.setattr(S._chunk_start, "__defaults__", (0,))
        got = {(r.k, r.idx): r for r in S.expanding_stats(df, one, chunk_rows=chunk).collect()}
    import statistics

    so_far = []
    for _, i, x in rows[:n]:
        so_far += [x] if x is not None else []
        if i % 37 == 0 and so_far:
            r = got["a", i]
            assert r.med == pytest.approx(statistics.median(so_far)) and r.av == pytest.approx(statistics.fmean(so_far))
            assert (r.lo, r.hi) == (min(so_far), max(so_far))
    assert got["b", 39].med == 1.0


def test_fitting_grains(history):
    scopes = {"": (), "_k": ("k",)}
    assert S.fitting_grains(history, scopes, "d", limit=10**6) == {"": "year", "_k": "year"}
    assert S.fitting_grains(history, scopes, "d", limit=10) == {"": "day", "_k": "day"}


def test_expanding_stats_go_through_a_chunk_once(spark, monkeypatch):
    """No frame that grows row by row, and no starts for a key of some thousand rows."""
    import statistics

    starts, own = [], S._chunk_start
    monkeypatch.setattr(S, "_chunk_start", lambda *args: starts.append(own(*args)) or starts[-1])
    df = spark.range(6000).selectExpr("id AS idx", "1 AS k", "id * 7919 % 6000 AS v")
    out = S.expanding_stats(df, S.Expanding("v", ("k",), ("idx",), F.col("idx"), {"median": "med", "max": "hi"}))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert starts == [None] and "MapInArrow" in plan and "percentile" not in plan
    v = [i * 7919 % 6000 for i in range(6000)]
    got = {r.idx: (r.med, r.hi) for r in out.collect()}
    assert all(got[i] == (statistics.median(v[: i + 1]), max(v[: i + 1])) for i in range(0, 6000, 123))


def test_rows_without_a_key_need_not_meet(spark):
    df = spark.range(4000).selectExpr("id AS idx", "CAST(NULL AS INT) AS k", "id AS v")
    out = S.expanding_stats(df, S.Expanding("v", ("k",), ("idx",), F.col("idx"), {"median": "med"}))
    assert "pmod(xxhash64(" in out._jdf.queryExecution().optimizedPlan().toString()  # dealt by their order, not as one group
    assert out.count() == 4000 and out.where("med IS NOT NULL").count() == 0


def test_half_of_a_start_is_cut_to_what_a_chunk_can_reach():
    assert S._halves([(1, 2), (5, 1), (9, 2)], 5, 100) == ([-5, -1, -1], [9, 9])
    low, high = S._halves([(0, 10**9), (3, 4), (7, 10**9)], 2 * 10**9 + 4, 6)
    assert low == [-3, -3, 0, 0, 0] and high == [3, 3, 7, 7, 7]
