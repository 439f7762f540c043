"""Operators that need an order: first and last rows, dense ordinals, neighbours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import map_values
from panelcast.operators.scan import BLOCK_BITS, by_day, by_id, fill_forward, lag, running_index, scan


def _keep(df: DataFrame, keys: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = pick(F.struct(*rest)).alias("__row")
    return df.groupBy(*keys).agg(row).select(
        *[F.col(c) if c in keys else F.col(f"__row.{c}") for c in df.columns]
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key. An aggregate, not a window: hot keys are combined map-side."""
    return _keep(df, keys, lambda row: F.min_by(row, F.struct(*order)))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _keep(df, keys, lambda row: F.max_by(row, F.struct(*order)))


def ordinal(
    df: DataFrame, day: str, *ids: str, name: str, start: int = 0, block_bits: int | None = BLOCK_BITS
) -> DataFrame:
    """Number the distinct (day, ids) of ``df`` in that order."""
    distinct = df.select(day, *ids).distinct()
    return scan(
        distinct, (by_day((), day, *ids, block_bits=block_bits), {name: running_index(start)})
    )


def global_lag(df: DataFrame, col: str, day: str, id_col: str, name: str) -> DataFrame:
    """Value of the row before in the whole table."""
    return scan(df, (by_day((), day, id_col), {name: lag(col)}))


def global_fill(df: DataFrame, col: str, day: str, id_col: str) -> DataFrame:
    """Forward fill over the whole table."""
    filled = scan(df, (by_day((), day, id_col), {"__filled": fill_forward(col)}))
    return filled.withColumn(col, F.col("__filled")).drop("__filled")


def previous_period(
    df: DataFrame, period: str, name: str, overrides: Mapping[int, int] | None = None
) -> DataFrame:
    """Each distinct period of ``df`` with the one before it; ``overrides`` replace a previous
    period by another one."""
    found = df.select(period).where(F.col(period).isNotNull()).distinct()
    before = scan(found, (by_id((), period), {name: lag(period)}))
    return before.withColumn(name, map_values(F.col(name), overrides or {}).cast(df.schema[period].dataType))


def topk_flag(
    df: DataFrame, keys: Sequence[str], ids: Sequence[str], order: Sequence[Column], k: int,
    where: Column, name: str,
) -> DataFrame:
    """1 for the first ``k`` rows of each key among those that satisfy ``where``, else 0.

    The filter on the rank lets Spark cut every group to ``k`` rows before the shuffle.
    ``ids`` tell the rows of one key apart.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    top = (
        df.where(where)
        .withColumn("__rank", rank)
        .where(F.col("__rank") <= k)
        .select(*keys, *ids, F.lit(1).alias(name))
    )
    return df.join(top, [*keys, *ids], "left").select(
        *df.columns, F.coalesce(name, F.lit(0)).alias(name)
    )
