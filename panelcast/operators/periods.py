"""Runs, periods, and statistics of the period before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import season
from panelcast.operators.scan import (
    CHUNK_LIMIT,
    Expanding,
    Timeline,
    by_day,
    by_id,
    expanding_stats,
    fill_forward,
    lag,
    running_index,
    running_sum,
    scan,
)
from panelcast.runtime import cut_lineage


def runs(
    df: DataFrame, scope: str, day: str, id_col: str, max_gap: int = 2, inherit: str = "global",
    name: str = "runid", grain: str = "day",
) -> DataFrame:
    """Number the runs of occasions.

    A run starts where the scope has no earlier occasion, or none within ``max_gap`` days; runs
    are numbered by (day, scope, id) of their start. An occasion that starts none takes the run
    that started last: of any scope (``inherit="global"``), so a return to a place after a stop
    elsewhere gets the stop's run, or of its own scope (``inherit="scope"``).
    ``grain`` is the scope's, see ``fitting_grains``.
    """
    with_gap = scan(df, (by_day([scope], day, id_col, grain=grain), {"__last": lag(day)}))
    starts = with_gap.withColumn(
        "__start",
        F.when(F.col("__last").isNull() | (F.datediff(day, "__last") > max_gap), 1).otherwise(0),
    )
    numbered = scan(starts, (by_day((), day, scope, id_col), {"__number": running_sum("__start")}))
    own = numbered.withColumn("__run", F.when(F.col("__start") == 1, F.col("__number") - 1))
    own = cut_lineage(own.select(*df.columns, "__run"))
    keys = [scope] if inherit == "scope" else []
    return scan(own, (by_day(keys, day, id_col), {name: fill_forward("__run")})).drop("__run")


def unified_period(
    df: DataFrame, tour: str, run: str, day: str, id_col: str, no_tour: int,
    name: str = "new_tourid",
) -> DataFrame:
    """One period id for all occasions: the tour where there is one, else the run.

    Periods are numbered from 0 by (day, id) of their first occasion.
    """
    on_tour = F.col(tour).isNotNull() & (F.col(tour) != no_tour)
    keyed = df.withColumns(
        {
            "__kind": F.when(on_tour, F.lit("T")).otherwise(F.lit("R")),
            "__period": F.when(on_tour, F.col(tour)).otherwise(F.col(run)),
        }
    )
    first = (
        keyed.groupBy("__kind", "__period")
        .agg(F.min(F.struct(F.col(day).alias("day"), F.col(id_col).alias("id"))).alias("__first"))
        .select("__kind", "__period", "__first.day", "__first.id")
    )
    numbers = scan(first, (by_day((), "day", "id"), {name: running_index()}))
    return keyed.join(numbers.drop("day", "id"), ["__kind", "__period"], "left").select(
        *df.columns, name
    )


def group_bounds(df: DataFrame, key: str, day: str, first: str, last: str) -> DataFrame:
    """First and last day of each key, on every row. An aggregate and a join, so that a key with
    very many rows is combined before the shuffle."""
    bounds = df.groupBy(key).agg(F.min(day).alias(first), F.max(day).alias(last))
    return df.join(bounds, key, "left").select(*df.columns, first, last)


def period_position(
    df: DataFrame, period: str, tour: str, run: str, day: str, id_col: str,
    number_by: str | None = None, grains: Mapping[str, str] | None = None,
) -> DataFrame:
    """Where an occasion stands in its period: days on it, days left, the season it began in, and
    its number.

    The number counts occasions of the raw ``tour`` (of ``number_by`` if given) and falls back
    to the position in the run. ``grains`` by column: see ``fitting_grains``.
    """
    counter, grains = number_by or tour, grains or {}
    out = scan(
        df,
        (by_day([run], day, id_col, grain=grains.get(run, "day")), {"current_run_venue": running_index()}),
        (by_day([counter], day, id_col, grain=grains.get(counter, "day")), {"__tour_number": running_index(1)}),
    )
    out = group_bounds(out, period, day, "__first", "__last")
    return out.withColumns(
        {
            "days_left_on_tour": F.abs(F.datediff(day, "__last")),
            "days_on_tour": F.coalesce(F.datediff(day, "__first"), "current_run_venue"),
            "tour_season": F.coalesce(season(F.col("__first")), season(F.col(day))),
            "tour_show_number": F.coalesce("__tour_number", "current_run_venue"),
        }
    ).drop("__first", "__last", "__tour_number")


def gap_stats(df: DataFrame, keys: Sequence[str], value: str, names: Mapping[str, str]) -> DataFrame:
    """Min, max, mean and median of ``value`` per key, in one aggregate."""
    stats = {"min": F.min, "max": F.max, "avg": F.avg, "median": F.median}
    return df.groupBy(*keys).agg(*[stats[s](value).alias(n) for s, n in names.items()])


def lagged_period_join(
    panel: DataFrame, stats: DataFrame, period: str, prev_period: str, by: Sequence[str]
) -> DataFrame:
    """Attach the statistics of period p to the rows whose previous period is p.

    The statistics are stored first, so that their size is known before the panel, which is many times
    larger, would be shuffled to meet them."""
    return panel.join(cut_lineage(stats).withColumnRenamed(period, prev_period), [prev_period, *by], "left")


def spine_fill(
    panel: DataFrame, keys: Sequence[str], stats: DataFrame, value: str, fill=0
) -> DataFrame:
    """Every combination of ``keys`` found in the panel (none of whose first key is null), with
    its value in ``stats`` or ``fill``."""
    spine = panel.select(*keys).where(F.col(keys[0]).isNotNull()).distinct()
    return spine.join(stats, list(keys), "left").fillna(fill, [value])


def expanding_over_periods(
    df: DataFrame, value: str, period: str, by: Sequence[str], names: Mapping[str, str]
) -> DataFrame:
    """Expanding stats of one value per period, along the periods of each key.

    Keys with more than ``CHUNK_LIMIT`` periods are cut into chunks, which is asked in a small job."""
    stored = cut_lineage(df)
    most = stored.dropna(subset=list(by)).groupBy(*by).count().agg(F.max("count")).first()[0]
    line = by_id(by, period) if (most or 0) > CHUNK_LIMIT else Timeline(tuple(by), (period,), ())
    at = cut_lineage(scan(stored, (line, {"__at": running_index()})))
    one = Expanding(value, tuple(by), (period,), F.col("__at"), names)
    return expanding_stats(at, one).drop("__at")


def closed_previous_period(df: DataFrame, period: str, day: str, name: str) -> DataFrame:
    """For each period, the newest period (by last day) that had ended before it began.

    The next lower number can be a period that is still running; this one never is.
    """
    bounds = df.groupBy(period).agg(F.min(day).alias("__first"), F.max(day).alias("__last"))
    ends = bounds.select(
        F.date_add("__last", 1).alias("__day"), F.lit(0).alias("__tag"), F.col(period).alias("__ended"),
        F.lit(None).cast(df.schema[period].dataType).alias(period),
    )
    begins = bounds.select(
        F.col("__first").alias("__day"), F.lit(1).alias("__tag"),
        F.lit(None).cast(df.schema[period].dataType).alias("__ended"), period,
    )
    line = Timeline((), ("__day", "__tag", "__ended", period), (F.col("__day"), F.col("__tag")))
    both = scan(ends.unionByName(begins), (line, {name: fill_forward("__ended")}))
    return both.where("__tag = 1").select(period, name)
