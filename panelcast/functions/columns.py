"""Column-level helpers: cleaning, keys, maps, sentinels, calendar values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Last month*100+day of each season, in order.
SEASON_ENDS = (
    (105, "nye_run"),
    (321, "winter"),
    (620, "spring"),
    (922, "summer"),
    (1220, "autumn"),
    (1226, "winter"),
    (1300, "nye_run"),
)
SEASON_CODES = {"nye_run": 0, "winter": 1, "spring": 2, "summer": 3, "autumn": 4}

WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def replace_where(df: DataFrame, col: str, values: Mapping) -> DataFrame:
    """Put another value where ``col`` equals one of the keys."""
    return df.withColumn(col, map_values(F.col(col), values))


def map_values(col: Column, mapping: Mapping) -> Column:
    """Value of ``mapping``, or the column's own value where it has none."""
    cases = reduce(lambda acc, kv: acc.when(col == F.lit(kv[0]), F.lit(kv[1])), mapping.items(), F)
    return cases.otherwise(col) if mapping else col


def fill_sentinel(df: DataFrame, value, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls by ``value``, in some columns or in all of a fitting type."""
    return df.fillna(value, list(cols) if cols is not None else None)


def lookup_key(*parts: str, unknown: Mapping[str, str] | None = None, optional: Sequence[str] = ()) -> Column:
    """Join the parts with ", ". A part equal to its ``unknown`` value and a null ``optional``
    part are left out; any other null part makes the key null. The last part always stays."""
    unknown = unknown or {}

    def piece(part: str) -> Column:
        text = F.concat(F.col(part), F.lit(", "))
        if part in unknown:
            text = F.when(F.col(part) == unknown[part], F.lit("")).otherwise(text)
        return F.coalesce(text, F.lit("")) if part in optional else text

    return F.concat(*[piece(p) for p in parts[:-1]], F.col(parts[-1]))


def is_cover(original: Column, has_album: Column, in_family: Column) -> Column:
    """1 for a piece that is not original, is on no album and is not by the family."""
    return F.when((original == 0) & ~has_album & ~in_family, 1).otherwise(0)


def cast_features(df: DataFrame, outcome: str | None = None) -> DataFrame:
    """Whole numbers become doubles, the outcome becomes a long."""
    return df.select(
        *[
            F.col(f.name).cast("long").alias(f.name)
            if f.name == outcome
            else F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, WHOLE_NUMBERS)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Names of the model features: everything that is not excluded."""
    return [c for c in df.columns if c not in set(exclude)]


def month_day(day: Column) -> Column:
    return F.month(day) * 100 + F.dayofmonth(day)


def season(day: Column) -> Column:
    """Season label of a date; each season includes its last day."""
    value = month_day(day)
    return reduce(lambda acc, b: acc.when(value <= b[0], F.lit(b[1])), SEASON_ENDS, F)


def season_code(day: Column) -> Column:
    return map_codes(season(day), SEASON_CODES)


def map_codes(col: Column, codes: Mapping[str, int]) -> Column:
    return reduce(lambda acc, kv: acc.when(col == kv[0], F.lit(kv[1])), codes.items(), F)


def days_since(day: Column, epoch: date) -> Column:
    return F.datediff(day, F.lit(epoch))


def calendar_features(df: DataFrame, day: str, epoch: date) -> DataFrame:
    """Season code, weekday (Monday = 0) and days since the epoch."""
    at = F.col(day)
    return df.withColumns(
        {
            "season": season_code(at),
            "day_of_week": F.weekday(at),
            "time_since_formation": days_since(at, epoch),
        }
    )
