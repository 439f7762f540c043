"""Running values over a whole table in any total order, dense ids or not.

The scan in ``scan`` cuts a history by the calendar and by blocks of ids, which only helps where ids
are dense. Here the rows are put into ranges of the order itself: Spark samples the order columns,
deals the rows over ranges of about equal size and sorts each. What passes from range to range is one
row each: how many rows it has, its last values, its last values that are not null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.runtime import cut_lineage

RANGE, POSITION = "__range", "__position"


def ranged(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df`` with the number of its range and its position there, from 1; stored.

    ``order`` must tell all rows apart, or rows that agree in it stay in one range, in any order.
    """
    parts = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).withColumn(RANGE, F.spark_partition_id())
    # the number is kept: what lies in which file when it is read back plays no part
    stored = cut_lineage(dealt)
    return stored.withColumn(POSITION, F.row_number().over(Window.partitionBy(RANGE).orderBy(*order)))


def running(
    df: DataFrame, order: Sequence[str], numbers: Mapping[str, int] | None = None, lags: Mapping[str, str] | None = None,
    fills: Mapping[str, str] | None = None, ranges: int | None = None,
) -> DataFrame:
    """``df`` with values along ``order`` over the whole table.

    ``numbers``: column -> first number; each row gets its place. ``lags``: column -> column whose
    value in the row before it takes. ``fills``: column -> column whose last value so far that is
    not null it takes. The rows are dealt and sorted once for all of them; one row per range meets
    in one task. An empty table stays empty.
    """
    numbers, lags, fills = numbers or {}, lags or {}, fills or {}
    columns = df.columns
    rows = ranged(df, order, ranges)
    at = F.struct(*order)
    ends = rows.groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.max_by(F.struct(F.col(c).alias("v")), at).alias(f"__lag_{name}") for name, c in lags.items()],
        *[
            F.max_by(F.struct(F.col(c).alias("v")), F.when(F.col(c).isNotNull(), at)).alias(f"__fill_{name}")
            for name, c in fills.items()
        ],
    )
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = cut_lineage(
        ends.select(
            RANGE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
            *[F.lag(f"__lag_{name}").over(Window.orderBy(RANGE)).alias(f"__lag_{name}") for name in lags],
            *[F.last(f"__fill_{name}", ignorenulls=True).over(before).alias(f"__fill_{name}") for name in fills],
        )
    )
    inside = Window.partitionBy(RANGE).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumns(
        {
            **{f"__own_{name}": F.lag(F.struct(F.col(c).alias("v"))).over(inside) for name, c in lags.items()},
            **{f"__own_{name}": F.last(c, ignorenulls=True).over(so_far) for name, c in fills.items()},
        }
    )
    met = own.join(carried, RANGE)
    return met.select(
        *[c for c in columns if c not in {*numbers, *lags, *fills}],
        *[(F.col("__before") + F.col(POSITION) + (start - 1)).cast("long").alias(name) for name, start in numbers.items()],
        # the first row of a range has none before it there, which is not a null value
        *[
            F.when(F.col(POSITION) > 1, F.col(f"__own_{name}")["v"]).otherwise(F.col(f"__lag_{name}")["v"]).alias(name)
            for name in lags
        ],
        *[F.coalesce(f"__own_{name}", F.col(f"__fill_{name}")["v"]).alias(name) for name in fills],
    )
