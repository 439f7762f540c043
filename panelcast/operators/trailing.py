"""Aggregates over a trailing stretch of the calendar."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.runtime import cut_lineage


def trailing_window(
    df: DataFrame, entity: str, day: str, aggs: Mapping[str, tuple[str, str]],
    months: int = 12, overrides: Mapping[int, int] | None = None,
) -> DataFrame:
    """The columns of ``trailing_by_day``, attached to every row.

    They are stored first, so that their size is known before ``df`` would be shuffled to meet them."""
    past = cut_lineage(trailing_by_day(df, entity, day, aggs, months, overrides))
    return df.join(past, [entity, day], "left").select(*df.columns, *aggs)


def trailing_by_day(
    df: DataFrame, entity: str, day: str, aggs: Mapping[str, tuple[str, str]],
    months: int = 12, overrides: Mapping[int, int] | None = None,
) -> DataFrame:
    """Per (entity, day) of ``df``: aggregates over ``start <= day' < day`` of the same entity, ``start`` being ``months``
    calendar months before the row's day (``overrides``: other lengths by year of the row).

    ``aggs`` maps a name to ("mean" or "sum", SQL value); a mean without values is null, a sum is 0.
    Values must be whole numbers. Rows are first summed per (entity, day), so a window holds one
    row per calendar day at most. A stretch is the difference of two running totals, which Spark
    extends row by row; a sliding frame would be summed anew at each row.
    """
    overrides = overrides or {}
    parts = {}
    for i, (_, value) in enumerate(aggs.values()):
        whole = F.expr(value).cast("long")
        parts[f"__s{i}"] = F.coalesce(F.sum(whole), F.lit(0)).alias(f"__s{i}")
        parts[f"__n{i}"] = F.count(whole).alias(f"__n{i}")
    daily = df.groupBy(entity, day).agg(*parts.values())

    def over(frame: str, part: str) -> Column:
        return F.expr(
            f"coalesce(sum({part}) OVER (PARTITION BY `{entity}` ORDER BY `{day}` RANGE BETWEEN {frame}), 0)"
        )

    def before(part: str, length: int) -> Column:
        start = f"INTERVAL '{length}' MONTH PRECEDING"
        up_to_day = over("UNBOUNDED PRECEDING AND CURRENT ROW", part) - F.col(part)
        up_to_start = over(f"UNBOUNDED PRECEDING AND {start}", part) - over(f"{start} AND {start}", part)
        return up_to_day - up_to_start

    lengths = {length: [y for y, m in overrides.items() if m == length]
               for length in sorted(set(overrides.values()) - {months})}
    picked = {}
    for part in parts:
        value = before(part, months)
        for length, years in lengths.items():
            value = F.when(F.year(day).isin(years), before(part, length)).otherwise(value)
        picked[part] = value
    past = daily.select(entity, day, *[v.alias(p) for p, v in picked.items()])
    results = []
    for i, (name, (kind, _)) in enumerate(aggs.items()):
        total, n = F.col(f"__s{i}"), F.col(f"__n{i}")
        results.append((F.try_divide(total, n) if kind == "mean" else total).alias(name))
    return past.select(entity, day, *results)


EPOCH = date(1970, 1, 1)


def map_trailing(
    df: DataFrame, entity: str, day: str, reach: int, per_day: Mapping[str, Column],
    fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, ids: Sequence[str],
    stretch: int = 366, block_rows: int = 65_536,
) -> DataFrame:
    """``fn(rows, days)`` for every entity and stretch of ``stretch`` days: any function of a row and
    the ``reach`` days before it.

    ``days`` has one row per day of the entity, from ``reach`` days before the stretch to its end, with
    the aggregates ``per_day``; both frames are in order of day, and ``fn`` returns ``schema``. A
    stretch with more than ``block_rows`` rows is dealt over blocks by a hash of ``ids``, which see
    the same days. So a call gets ``block_rows`` rows and ``stretch + reach`` days, about, whatever
    the length of the entity's history. Rows without entity or day are left out.
    """
    rows = df.where(F.col(entity).isNotNull() & F.col(day).isNotNull())
    number = F.datediff(day, F.lit(EPOCH))
    rows = rows.withColumn("__stretch", F.floor(number / stretch))
    daily = rows.groupBy(entity, day).agg(*[c.alias(name) for name, c in per_day.items()])
    sizes = rows.groupBy(entity, "__stretch").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("__blocks"))
    own = rows.join(sizes, [entity, "__stretch"]).withColumn("__block", F.pmod(F.xxhash64(*ids), "__blocks")).drop("__blocks")
    serves = F.sequence(F.floor(number / stretch), F.floor((number + reach) / stretch))
    halo = daily.withColumn("__stretch", F.explode(serves)).join(sizes, [entity, "__stretch"])
    halo = halo.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1))).drop("__blocks")
    # a stretch needs no days beyond the reach of its first one
    halo = halo.where(number >= F.col("__stretch") * stretch - reach)
    halo = halo.toDF(*halo.columns)  # columns of its own, so that the two sides can be told apart
    inner = ["__stretch", "__block"]

    def call(mine: pd.DataFrame, days: pd.DataFrame) -> pd.DataFrame:
        mine, days = (x.drop(columns=inner).sort_values(day, kind="stable").reset_index(drop=True) for x in (mine, days))
        for x in (mine, days):
            x[day] = pd.to_datetime(x[day])
        return fn(mine, days)

    keys = [entity, *inner]
    return own.groupBy(*keys).cogroup(halo.groupBy(*keys)).applyInPandas(call, schema)
