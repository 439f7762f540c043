"""The entity x occasion panel, and what each of its rows knows of the past."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from panelcast.operators.scan import CHUNK_LIMIT, STATS
from panelcast.runtime import cut_lineage

BLOCK = 8  # 2**8 occasions share one block of the panel join


def debuts(plays: DataFrame, entity: str, day: str, name: str) -> DataFrame:
    """First day of each entity."""
    return plays.groupBy(entity).agg(F.min(day).alias(name))


def build_panel(
    occasions: DataFrame, firsts: DataFrame, day: str, first_day: str, number: str,
    block_bits: int = BLOCK, own: DataFrame | None = None, ids: Sequence[str] = (), carry: Sequence[str] = (),
) -> DataFrame:
    """Every occasion with every entity that appeared on or before its day.

    ``number`` numbers the occasions by day. Entities are laid out over the blocks of occasions
    from their first day on and joined on the block, so no task sees more than one block of
    occasions and the join stays an equi-join.

    ``own`` has rows of ``ids`` (occasion, entity), ``day`` and ``number``; its other columns are
    attached, null where it has no row. They travel with their occasion, so the panel itself is not
    shuffled. Those named in ``carry`` hold instead the newest value that is not null strictly
    before the row, along (day, occasion): what an entity had before a block comes with the block.
    """
    block = F.shiftright(F.col(number), block_bits)
    days = occasions.groupBy(F.col(day).alias(first_day)).agg(F.min(block).alias("__from"))
    last = occasions.agg(F.max(block)).scalar()
    spine = firsts.join(days, first_day, "left").select(
        *firsts.columns,
        F.explode(F.sequence(F.coalesce("__from", F.lit(0)), last)).alias("__block"),
    )
    shows = occasions.withColumn("__block", block)
    if own is not None:
        show, entity = ids
        values = [c for c in own.columns if c not in {*ids, day, number}]
        found = own.where(F.col(show).isNotNull() & F.col(entity).isNotNull())
        per_show = found.groupBy(show).agg(F.collect_list(F.struct(entity, *values)).alias("__own"))
        shows = shows.join(per_show, show, "left")
        if carry:
            along = F.struct(day, show)
            newest = found.groupBy(entity, block.alias("__block")).agg(
                *[F.max_by(c, F.when(F.col(c).isNotNull(), along)).alias(f"__newest_{c}") for c in carry]
            )
            before = Window.partitionBy(entity).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
            spine = spine.join(newest, [entity, "__block"], "left").select(
                *spine.columns, *[F.last(f"__newest_{c}", ignorenulls=True).over(before).alias(f"__in_{c}") for c in carry]
            )
        # a block's rows stay together, and are not shuffled again below
        shows = shows.repartition("__block")
    rows = shows.join(spine, "__block").where(F.col(day) >= F.col(first_day))
    if own is None:
        return rows.drop("__block")
    here = F.filter("__own", lambda x: x[entity] == F.col(entity))
    rows = rows.withColumn("__here", F.explode_outer(here))
    kept = [c for c in rows.columns if c not in {"__block", "__own", "__here"} and not c.startswith("__in_")]
    if not carry:
        return rows.select(*kept, *[F.col("__here")[c].alias(c) for c in values])
    so_far = Window.partitionBy("__block", entity).orderBy(day, show).rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("*", *[F.col("__here")[c].alias(c) for c in values]).select(
        *kept, *[c for c in values if c not in carry],
        *[F.coalesce(F.last(c, ignorenulls=True).over(so_far), f"__in_{c}").alias(c) for c in carry],
    )


def next_occasion(
    known: DataFrame, candidates: DataFrame, day: str, ids: Sequence[str], number: str,
    previous: Mapping[str, str],
) -> DataFrame:
    """The first candidate after the last known day, numbered next; empty if there is none.

    ``previous`` maps a period column to the column of its previous period. The next occasion's
    previous period is the newest known one or, where it still belongs to that one, the one
    before. Of several known occasions on a day, only the last one counts as the newest. ``known`` may
    hold an occasion several times; only the rows of each day's last first id are ordered.
    """
    measured = [number, *previous, *previous.values()]
    tops = known.groupBy(F.col(day).alias("__day")).agg(F.max(ids[0]).alias("__top"))
    of_last = known.join(tops, F.col(day).eqNullSafe(F.col("__day")) & F.col(ids[0]).eqNullSafe(F.col("__top")), "left_semi")
    per_day = of_last.groupBy(day).agg(
        F.max_by(F.struct(*measured), F.struct(*ids)).alias("__last")
    )
    newest = per_day.agg(
        F.struct(
            F.max(day).alias("day"), *[F.max(f"__last.{c}").alias(c) for c in measured]
        ).alias("newest")
    ).scalar()
    ahead = (
        candidates.withColumn("__known", newest)
        .where(F.col(day) > F.col("__known.day"))
        .orderBy(day, *ids)
        .limit(1)
    )
    out = ahead.withColumn(number, F.col(f"__known.{number}") + 1)
    for period, before in previous.items():
        out = out.withColumn(
            before,
            F.when(F.col(period) == F.col(f"__known.{period}"), F.col(f"__known.{before}"))
            .otherwise(F.col(f"__known.{period}")),
        )
    return out.drop("__known")


def panel_recency(
    panel: DataFrame, scopes: Mapping[str, Sequence[str]], entity: str, day: str, id_col: str,
    played: str = "played", count: str = "num_times_played_song", gap: str = "gap_song",
    since: str = "time_last_played_song", extra: Mapping[str, Mapping[str, str]] | None = None,
    chunk_rows: int = CHUNK_LIMIT,
) -> DataFrame:
    """What was known before each row, per scope: days since the last occurrence, occurrences so
    far, gap stats as of the last one (days since it while there is no gap yet).

    The panel's own ``count`` and gap-stat columns hold the values as of each occurrence and are
    replaced. They change together, at occurrences only. ``extra`` carries more: a 0/1 column ->
    {column to read: name to write}. ``panel`` should be a stored table: it is read a few times.

    All scopes share one shuffle, by entity and stretch of days with about ``chunk_rows`` rows of an
    entity. A stretch also gets copies of those earlier occurrences that are the newest of a key it
    holds, see ``_carried``.
    """
    stats = [f"{s}_{gap}" for s in STATS]
    read = {}  # (scope columns, 0/1 column) -> columns whose last values are asked
    for suffix, cols in scopes.items():
        own = read.setdefault((tuple(cols), played), [day])
        own += [f"{c}{suffix}" for c in [count, *stats]]
        if not cols:
            for flag, columns in (extra or {}).items():
                read.setdefault(((), flag), []).extend(columns)
    tracks = [(cols, flag, list(dict.fromkeys(own))) for (cols, flag), own in read.items()]
    past = {(cols, flag, c): f"__past{i}_{j}" for i, (cols, flag, own) in enumerate(tracks) for j, c in enumerate(own)}
    replaced = {f"{c}{s}" for s in scopes for c in [count, *stats]}
    replaced |= {c for columns in (extra or {}).values() for c in columns} - {day, entity, id_col}
    kept = [c for c in panel.columns if c not in replaced]

    days = cut_lineage(_stretches(panel, entity, day, chunk_rows))
    rows = panel.join(days, day, "left").withColumn("__chunk", F.coalesce("__chunk", F.lit(-1).cast("long")))
    every = rows.withColumn("__track", F.lit(-1))
    for i, track in enumerate(tracks):
        every = every.unionByName(_carried(rows, track, entity, day, id_col).withColumn("__track", F.lit(i)), allowMissingColumns=True)
    types = {f.name: f for f in panel.schema}
    schema = StructType([types[c] for c in kept] + [StructField(n, types[c].dataType) for (_, _, c), n in past.items()])

    def known(table: pa.Table) -> pa.Table:
        """Each row of one entity's stretch, with the values of the flagged row before it in its key."""
        along = [(day, "ascending"), (id_col, "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=along, null_placement="at_start"))
        track = table.column("__track").to_numpy()
        own = np.flatnonzero(track < 0)
        out = {c: table.column(c).take(own) for c in kept}
        for i, (cols, flag, names) in enumerate(tracks):
            at = np.flatnonzero((track < 0) | (track == i))
            code = _codes(table, [*cols, entity])[at]
            order = np.argsort(code, kind="stable")
            at, code, n = at[order], code[order], np.arange(len(at))
            hit = pc.fill_null(pc.equal(table.column(flag), 1), False).to_numpy()[at]
            last = np.maximum.accumulate(np.where(hit, n, -1))
            before = np.concatenate([[-1], last[:-1]])
            first = np.maximum.accumulate(np.where(np.concatenate([[True], code[1:] != code[:-1]]), n, 0))
            source = np.full(len(track), -1)
            source[at] = np.where((before >= first) & (code >= 0), at[before], -1)
            source = pa.array(source[own], mask=source[own] < 0)
            out |= {past[cols, flag, c]: table.column(c).take(source) for c in names}
        return pa.table(out)

    out = every.groupBy(entity, "__chunk").applyInArrow(known, schema)
    results = []
    for suffix, cols in scopes.items():
        value = lambda c, of=tuple(cols): F.col(past[of, played, c])
        since_last = F.datediff(day, value(day))
        results += [since_last.alias(f"{since}{suffix}"), value(f"{count}{suffix}").alias(f"{count}{suffix}")]
        results += [F.coalesce(value(f"{s}{suffix}"), since_last).cast("double").alias(f"{s}{suffix}") for s in stats]
    for flag, columns in (extra or {}).items():
        results += [F.col(past[(), flag, c]).alias(n) for c, n in columns.items()]
    return out.select(*kept, *results)


def _stretches(panel: DataFrame, entity: str, day: str, chunk_rows: int) -> DataFrame:
    """Each day with the number of its stretch (``__chunk``): days in a row with about
    ``chunk_rows`` rows of the entity that has most, a longer day alone."""
    per_day = panel.where(F.col(day).isNotNull()).groupBy(entity, day).count().groupBy(day).agg(F.max("count").alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy(day).rowsBetween(Window.unboundedPreceding, -1))
    return per_day.select(day, F.floor(F.coalesce(before, F.lit(0)) / chunk_rows).alias("__chunk"))


def _carried(rows: DataFrame, track: tuple, entity: str, day: str, id_col: str) -> DataFrame:
    """The newest flagged row of each key and stretch, in the later stretches that hold the key's
    scope, up to the next one with a flagged row.

    So a stretch has one such row per key at most, and only for keys with rows in it or, where an
    entity lacks rows of its scope, in its neighbours.
    """
    cols, flag, values = track
    keys, along = [*cols, entity], F.struct(day, id_col)
    named = lambda names: [F.col(c).isNotNull() for c in names]
    flagged = rows.where(reduce(lambda a, b: a & b, [F.col(flag) == 1, *named(keys)]))
    row = F.struct(*dict.fromkeys([day, id_col, *values]))
    newest = flagged.groupBy(*keys, "__chunk").agg(F.max_by(row, along).alias("__row"))
    until = F.lead("__chunk").over(Window.partitionBy(*keys).orderBy("__chunk"))
    newest = newest.withColumns({"__from": F.col("__chunk"), "__until": until}).drop("__chunk")
    held = rows.select(*cols, "__chunk").distinct().groupBy(*cols).agg(F.collect_list("__chunk").alias("__held"))
    met = newest.join(held, list(cols)) if cols else newest.crossJoin(held)
    later = F.filter("__held", lambda c: (c > F.col("__from")) & (F.col("__until").isNull() | (c <= F.col("__until"))))
    return met.select(*keys, "__row.*", F.lit(1).alias(flag), F.explode(later).alias("__chunk"))


def _codes(table: pa.Table, cols: Sequence[str]) -> np.ndarray:
    """A number per row, equal where all ``cols`` are, and -1 where one of them is null."""
    code = np.zeros(len(table), np.int64)
    for c in cols:
        found = table.column(c).combine_chunks().dictionary_encode()
        here = pc.fill_null(found.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        code = np.where((code < 0) | (here < 0), -1, code * (len(found.dictionary) + 1) + here)
    return code
