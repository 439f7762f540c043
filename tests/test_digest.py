"""Digests of wide tables against sums row by row."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from panelcast.plans import digest, queries

ROWS = [
    (0, 999_999_999, 10, 41 / 640, 3), (0, 7, 20, -1.0, None), (0, 8, 20, 2_147_483_648.123457, -1), (1, 5, 1, None, 4),
    (1, None, 2, 0.5, -1), (None, 6, 3, -12.000001, 9), (0, 12, 5, 999_999_999_999.25, 9), (0, 13, 5, -7_000_000_000.000001, 9),
] + [(2, i, i % 25, (i * 37 % 1001 - 500) / 7, i % 3 - 1) for i in range(9000)]


def test_profile_equals_decimals_row_by_row_and_makes_no_row_per_value(spark):
    df = spark.createDataFrame(ROWS, "grp int, showid long, songid long, a double, b int")
    got = queries.profile(df, "grp", ["a", "b"])
    assert "Expand" not in got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    found = {(r["grp"], r["feature"]): tuple(r)[2:] for r in got.collect()}
    digits = df.select("grp", "showid", "songid", *[queries.six_digits(c).alias(c) for c in "ab"]).collect()
    want = {}
    for g in (0, 1, 2, None):
        for c in "ab":
            own = [r for r in digits if r["grp"] == g]
            value = lambda r, c=c: None if r[c] is None else Decimal(repr(r[c])).quantize(Decimal("1e-6"), ROUND_HALF_UP)
            held = [value(r) for r in own if r[c] is not None]
            weighed = [value(r) * (r["showid"] + 31 * r["songid"]) for r in own if r[c] is not None and r["showid"] is not None]
            want[g, c] = (
                len(own), sum(v == -1 for v in held), f"{sum(held):.6f}" if held else None, f"{sum(weighed):.6f}" if weighed else None,
                float(min(held)) if held else None, float(max(held)) if held else None,
            )
    assert found == want


def test_profile_refuses_what_its_sums_cannot_hold(spark):
    df = spark.createDataFrame([(0, 1, 1, 1e12)], "grp int, showid long, songid long, a double")
    with pytest.raises(Exception, match="12 digits"):
        queries.profile(df, "grp", ["a"]).collect()


def test_moments_equal_plain_aggregates(spark):
    rows = [(i % 3 if i % 7 else None, [i * 0.5, float(i % 11) - 5]) for i in range(500)]
    df = spark.createDataFrame(rows, "played long, x array<double>")
    got = digest.moments(df, "played", F.col("x"), ["p", "q"])
    for r in got.collect():
        v = [x["pq".index(r["feature"])] for y, x in rows if y == r["played"]]
        assert (r["n"], r["low"], r["high"]) == (len(v), min(v), max(v))
        assert (r["average"], r["square"]) == pytest.approx((sum(v) / len(v), sum(a * a for a in v) / len(v)))
    assert got.count() == 8
