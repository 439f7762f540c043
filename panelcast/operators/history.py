"""What is known of a key's past at each of its rows: neighbours, gaps and expanding stats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.scan import (
    STATS,
    Expanding,
    by_day,
    expanding_stats,
    fill_forward,
    lag,
    last_before,
    lead,
    running_index,
    scan,
)


def lag_gap(df: DataFrame, keys: Sequence[str], day: str, id_col: str, name: str) -> DataFrame:
    """Days since the row before of the same key."""
    out = scan(df, (by_day(keys, day, id_col), {"__other": lag(day)}))
    return out.withColumn(name, F.datediff(day, "__other")).drop("__other")


def lead_gap(df: DataFrame, keys: Sequence[str], day: str, id_col: str, name: str) -> DataFrame:
    """Days to the row after, as a negative number."""
    out = scan(df, (by_day(keys, day, id_col), {"__other": lead(day)}))
    return out.withColumn(name, F.datediff(day, "__other")).drop("__other")


def running_count(
    df: DataFrame, keys: Sequence[str], day: str, id_col: str, name: str, start: int = 0
) -> DataFrame:
    return scan(df, (by_day(keys, day, id_col), {name: running_index(start)}))


def carry_forward(
    df: DataFrame, col: str, keys: Sequence[str], day: str, id_col: str, name: str,
    include_row: bool = False,
) -> DataFrame:
    """Newest non-null value of the key strictly before the row, or up to it."""
    value = fill_forward(col) if include_row else last_before(col)
    return scan(df, (by_day(keys, day, id_col), {name: value}))


def scope_history(
    df: DataFrame, scopes: Mapping[str, str], day: str, id_col: str, grains: Mapping[str, str] | None = None
) -> DataFrame:
    """Per occasion: how many before it and days since the last one, in each scope and overall.

    ``grains``: see ``fitting_grains``; overall it is always days.
    """
    passes = [
        (
            by_day([col], day, id_col, grain=(grains or {}).get(scope, "day")),
            {f"num_show_{scope}": running_index(), f"__last_{scope}": lag(day)},
        )
        for scope, col in scopes.items()
    ]
    overall = (by_day((), day, id_col), {"show_number": running_index(1), "__last_show": lag(day)})
    out = scan(df, *passes, overall)
    since = {f"time_since_last_{s}": F.datediff(day, f"__last_{s}") for s in [*scopes, "show"]}
    return out.withColumns(since).drop(*[f"__last_{s}" for s in [*scopes, "show"]])


def play_gaps(
    df: DataFrame, scopes: Mapping[str, Sequence[str]], entity: str, day: str, id_col: str,
    number: str | None = None, count: str = "num_times_played_song", gap: str = "gap_song",
    number_gap: str = "show_gap_song", grains: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per occurrence and scope: its count so far and the days since the one before.

    ``scopes`` maps a name suffix to the columns that are grouped by besides ``entity``. With
    ``number``, the gap in occasions is added too. ``grains``: see ``fitting_grains``.
    """
    passes = []
    for suffix, cols in scopes.items():
        values = {f"{count}{suffix}": running_index(1), f"__last{suffix}": lag(day)}
        if number and not cols:
            values["__last_number"] = lag(number)
        grain = (grains or {}).get(suffix, "day")
        passes.append((by_day([*cols, entity], day, id_col, grain=grain), values))
    out = scan(df, *passes)
    gaps = {f"{gap}{s}": F.datediff(day, f"__last{s}") for s in scopes}
    if number:
        gaps[number_gap] = F.col(number) - F.col("__last_number")
    return out.withColumns(gaps).drop(*[f"__last{s}" for s in scopes], "__last_number")


def expanding_by_scope(
    df: DataFrame, entity: str, day: str, id_col: str,
    values: Mapping[str, Mapping[str, Sequence[str]]], count: str = "num_times_played_song",
) -> DataFrame:
    """Expanding min, max, mean and median of each value in each of its scopes.

    ``values`` maps a name to the scopes whose column ``name + suffix`` is to be summed up;
    ``count`` + suffix is the 1-based position from ``play_gaps``. ``df`` is a stored table.
    """
    passes = [
        Expanding(
            f"{value}{scope}", (*cols, entity), (day, id_col), F.col(f"{count}{scope}") - 1,
            {stat: f"{stat}_{value}{scope}" for stat in STATS},
        )
        for value, scopes in values.items()
        for scope, cols in scopes.items()
    ]
    return expanding_stats(df, *passes)
