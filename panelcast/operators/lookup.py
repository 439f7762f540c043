"""Joins with reference tables: deduplicated, as-of, fallback chains, incremental."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.order import keep_first
from panelcast.operators.scan import BLOCK_BITS, Timeline, fill_forward, scan


def join_dim(df: DataFrame, dim: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Left join with the first row per key of a dimension, so no row is doubled."""
    return df.join(keep_first(dim, [key], order), key, "left")


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_day: str, right_day: str,
    values: Sequence[str], id_col: str | None = None, block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """For each left row, ``values`` of the newest right row of its key with
    ``right_day <= left_day``; right rows of one day are ranked by ``values``.

    Both sides go through one forward fill, so no pair of rows is ever built.
    ``id_col`` is an integer that cuts a day with very many left rows of one key into blocks.
    """
    facts = right.where(F.col(right_day).isNotNull()).select(
        *by, F.col(right_day).alias("__day"), F.lit(0).alias("__tag"), F.struct(*values).alias("__fact")
    )
    rows = left.withColumns({"__day": F.col(left_day), "__tag": F.lit(1)})
    order, chunk = ("__day", "__tag", "__fact"), (F.col("__day"), F.col("__tag"))
    if id_col:
        order += (id_col,)
        chunk += (F.coalesce(F.shiftright(F.col(id_col), block_bits), F.lit(0)),)
    line = Timeline(tuple(by), order, chunk)
    filled = scan(
        rows.unionByName(facts, allowMissingColumns=True), (line, {"__match": fill_forward("__fact")})
    )
    return filled.where("__tag = 1").select(
        *left.columns, *[F.col(f"__match.{v}").alias(v) for v in values]
    )


def lookup_chain(
    df: DataFrame, ref: DataFrame, keys: Sequence[str], ref_key: str, values: Sequence[str]
) -> DataFrame:
    """Values from ``ref`` by the first of ``keys`` that is found there, else null."""
    known = ref.select(ref_key, F.struct(*values).alias("__hit"))
    known = keep_first(known, [ref_key], ["__hit"])
    out, hits = df, []
    for i, key in enumerate(keys):
        hits.append(f"__hit{i}")
        side = known.select(F.col(ref_key).alias(f"__ref{i}"), F.col("__hit").alias(f"__hit{i}"))
        out = out.join(side, F.col(key) == F.col(f"__ref{i}"), "left")
    hit = F.coalesce(*hits)
    return out.select(*df.columns, *[hit[v].alias(v) for v in values])


def unresolved(todo: DataFrame, done: DataFrame, key: str, resolved: Column) -> DataFrame:
    """Rows of ``todo`` that ``done`` does not hold in resolved form."""
    return todo.join(done.where(resolved).select(key), key, "left_anti")


def incremental_merge(done: DataFrame, fresh: DataFrame, resolved: Column) -> DataFrame:
    """The resolved old rows and the newly processed ones; missing columns become null."""
    return done.where(resolved).unionByName(fresh, allowMissingColumns=True)


def min_support(df: DataFrame, support: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """Rows of the keys whose ``value`` sums to at least ``n`` in ``support``."""
    keys = support.groupBy(key).agg(F.sum(value).alias("__sum")).where(F.col("__sum") >= n)
    return df.join(keys.select(key), key, "left_semi")
