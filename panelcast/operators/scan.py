"""Running values along long, skewed histories.

``Window.partitionBy(entity).orderBy(date)`` puts the whole history of one entity into one task.
When one entity holds a third of the rows that task never ends. The functions here cut each
history into chunks that follow the order (a date, and blocks of ids inside a date), work inside
each chunk with an ordinary window, and carry one small row per chunk forward:

1. one aggregate per (key, chunk), combined before the shuffle;
2. a window over those chunk rows per key: a key has as many as its calendar has chunks;
3. the rows' own window, partitioned by (key, chunk), joined with what was carried in.

The rows are shuffled once, as with the plain window, but a hot key spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce
from heapq import heappush, heappushpop

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from panelcast.runtime import cut_lineage

BLOCK_BITS = 20  # ids inside one date are cut into blocks of 2**20
CHUNK_LIMIT = 2**16  # rows of one key that may share a year or a month
CHUNK_ROWS = 2**16  # rows of one key that one task goes through in expanding_stats
FAN = 64  # ranges into which a key's values are cut, twice
FEW_CHUNKS = 64  # up to so many chunks of one key, values are repeated per chunk


@dataclass(frozen=True)
class Timeline:
    """Rows of each key (the whole table if there is none) in a total order.

    ``chunk`` holds expressions that never fall along ``order``; they cut the history. Without any,
    each key's history is one window and nothing is carried.
    Rows with a null key get null results.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunk: tuple[Column, ...]


def by_day(
    keys, day: str, *ids: str, grain: str = "day", block_bits: int | None = BLOCK_BITS
) -> Timeline:
    """Order by ``day``, then ``ids``, cut into years, months or days (``grain``), or not at all
    (``grain="all"``), which is for keys with few rows: their chunks would be as many as the rows.

    At grain "day" the first id, an integer, also cuts long days into blocks: with at most one row
    per key and id, no chunk exceeds 2**block_bits rows. Where ids are scattered (hashes), pass
    ``block_bits=None``. Coarser grains mean fewer chunks to carry; see ``fitting_grains``.
    """
    if grain == "all":
        chunk = []
    elif grain != "day":
        chunk = [F.trunc(day, grain)]
    else:
        chunk = [F.col(day)]
        if ids and block_bits is not None:
            chunk.append(F.shiftright(F.col(ids[0]), block_bits))
    return Timeline(tuple(keys), (day, *ids), tuple(chunk))


def fitting_grains(
    df: DataFrame, scopes: Mapping[str, tuple[str, ...]], day: str, limit: int = CHUNK_LIMIT,
    id_col: str | None = None,
) -> dict[str, str]:
    """The coarsest grain for each scope at which no chunk has more than ``limit`` rows of ``df``.

    One small job; a row per scope comes back. Where even months are too long it is "day". With
    ``id_col``, a scope none of whose keys has more than ``limit`` rows gets "all", and all get "day"
    if there are rows without id: only there they are apart from the others.
    """
    largest = []
    for scope, cols in scopes.items():
        months = df.groupBy(*cols, F.trunc(day, "month").alias("__month")).count()
        years = months.groupBy(*cols, F.trunc("__month", "year")).agg(
            F.sum("count").alias("year"), F.max("count").alias("month")
        )
        whole = years.groupBy(*cols).agg(F.sum("year").alias("all"), F.max("year").alias("year"), F.max("month").alias("month"))
        largest.append(whole.agg(F.lit(scope).alias("scope"), F.max("all"), F.max("year"), F.max("month")))
    if id_col:
        unnamed = df.select(F.count_if(F.col(id_col).isNull()))
        largest.append(unnamed.select(F.lit(None).cast("string"), *[F.col(unnamed.columns[0])] * 3))
    found = reduce(DataFrame.unionAll, largest).collect()
    if id_col and found.pop()[1]:
        return dict.fromkeys(scopes, "day")
    return {
        scope: "all" if id_col and (whole or 0) <= limit else "year" if (year or 0) <= limit else "month" if month <= limit else "day"
        for scope, whole, year, month in found
    }


def by_id(keys, id_col: str, block_bits: int = 12) -> Timeline:
    """Order by an integer id without gaps of note (a period number), cut into blocks."""
    return Timeline(tuple(keys), (id_col,), (F.shiftright(F.col(id_col).cast("long"), block_bits),))


@dataclass(frozen=True)
class Running:
    """One running value: how a chunk is summed up, carried, computed inside it, and merged."""

    chunk: Callable[[Column], Column]  # struct of order columns -> aggregate
    carry: Callable[[Column, WindowSpec], Column]  # chunk aggregate, window over chunks
    local: Callable[[WindowSpec], Column]
    merge: Callable[[Column, Column], Column]  # carried, local
    before: int | None = None  # what is carried into the first chunk


def _past(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def _box(col: str) -> Column:
    return F.struct(F.col(col).alias("v"))


def _newest(col: str, at: Column) -> Column:
    return F.max_by(F.col(col), F.when(F.col(col).isNotNull(), at))


def running_index(start: int = 0) -> Running:
    """Position of the row in its key, from ``start``."""
    return Running(
        lambda at: F.count(F.lit(1)),
        lambda s, w: F.coalesce(F.sum(s).over(_past(w)), F.lit(0)),
        lambda w: F.row_number().over(w),
        lambda c, x: (c + x + F.lit(start - 1)).cast("long"),
        0,
    )


def running_sum(col: str) -> Running:
    return Running(
        lambda at: F.sum(col),
        lambda s, w: F.sum(s).over(_past(w)),
        lambda w: F.sum(col).over(_so_far(w)),
        lambda c, x: F.coalesce(c + x, c, x),
    )


def running_min(col: str) -> Running:
    return Running(
        lambda at: F.min(col),
        lambda s, w: F.min(s).over(_past(w)),
        lambda w: F.min(col).over(_so_far(w)),
        F.least,
    )


def running_max(col: str) -> Running:
    return Running(
        lambda at: F.max(col),
        lambda s, w: F.max(s).over(_past(w)),
        lambda w: F.max(col).over(_so_far(w)),
        F.greatest,
    )


def lag(col: str) -> Running:
    """Value of the row before, null or not."""
    return Running(
        lambda at: F.max_by(_box(col), at),
        lambda s, w: F.lag(s).over(w),
        lambda w: F.lag(_box(col)).over(w),
        lambda c, x: F.coalesce(x, c)["v"],
    )


def lead(col: str) -> Running:
    """Value of the row after, null or not."""
    return Running(
        lambda at: F.min_by(_box(col), at),
        lambda s, w: F.lead(s).over(w),
        lambda w: F.lead(_box(col)).over(w),
        lambda c, x: F.coalesce(x, c)["v"],
    )


def last_before(col: str) -> Running:
    """Newest non-null value strictly before the row."""
    return Running(
        lambda at: _newest(col, at),
        lambda s, w: F.last(s, ignorenulls=True).over(_past(w)),
        lambda w: F.last(col, ignorenulls=True).over(_past(w)),
        lambda c, x: F.coalesce(x, c),
    )


def fill_forward(col: str) -> Running:
    """Newest non-null value up to and including the row."""
    return Running(
        lambda at: _newest(col, at),
        lambda s, w: F.last(s, ignorenulls=True).over(_past(w)),
        lambda w: F.last(col, ignorenulls=True).over(_so_far(w)),
        lambda c, x: F.coalesce(x, c),
    )


def scan(df: DataFrame, *passes: tuple[Timeline, Mapping[str, Running]]) -> DataFrame:
    """Add running values. Each pass reads only columns of ``df``, not those of other passes."""
    out = df
    for timeline, values in passes:
        out = _one_pass(df, out, timeline, values)
    return out


def _one_pass(base: DataFrame, out: DataFrame, timeline: Timeline, values) -> DataFrame:
    keys, columns = list(timeline.keys), out.columns
    chunk = [f"__chunk{i}" for i in range(len(timeline.chunk))]
    cut = [c.alias(name) for name, c in zip(chunk, timeline.chunk)]
    at = F.struct(*timeline.order)
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    if not chunk:
        whole = Window.partitionBy(*keys).orderBy(*timeline.order)
        rows = out.select("*", *[v.local(whole).alias(f"__{n}_own") for n, v in values.items()])
        # as with chunks, nothing is carried to rows without a day
        dated = F.col(timeline.order[0]).isNotNull()
        return rows.select(
            *columns,
            *[
                F.when(named, v.merge(F.when(dated, F.lit(v.before)), F.col(f"__{n}_own"))).alias(n)
                if v.before is not None else F.when(named, v.merge(F.lit(None), F.col(f"__{n}_own"))).alias(n)
                for n, v in values.items()
            ],
        )

    chunks = (
        base.where(named)
        .groupBy(*keys, *cut)
        .agg(*[v.chunk(at).alias(f"__{name}") for name, v in values.items()])
    )
    along = Window.partitionBy(*keys).orderBy(*chunk)
    carried = chunks.select(
        *keys, *chunk, *[v.carry(F.col(f"__{n}"), along).alias(f"__{n}_in") for n, v in values.items()]
    )
    inside = Window.partitionBy(*keys, *chunk).orderBy(*timeline.order)
    rows = out.select("*", *cut).select(
        "*", *[v.local(inside).alias(f"__{n}_own") for n, v in values.items()]
    )
    return rows.join(carried, [*keys, *chunk], "left").select(
        *columns,
        *[
            F.when(named, v.merge(F.col(f"__{n}_in"), F.col(f"__{n}_own"))).alias(n)
            for n, v in values.items()
        ],
    )


STATS = ("min", "max", "avg", "median")


@dataclass(frozen=True)
class Expanding:
    """Stats of ``value`` over the rows of a key so far.

    ``index`` is the column with the 0-based position of the row in its key (``running_index``);
    ``names`` maps min/max/avg/median to output columns.
    """

    value: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    index: Column
    names: Mapping[str, str]


def expanding_stats(df: DataFrame, *passes: Expanding, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Min, max, mean and exact interpolated median of a value up to and including each row.

    The position in the key cuts it into chunks of ``chunk_rows``. Each later chunk starts from
    the counts of those values before it that its medians can still reach; the rest is folded into
    one entry at either end. A task goes through the rows of its chunks once and keeps the values
    of one chunk in two heaps, so a row costs the logarithm of a chunk's rows however long the
    history is. For long histories, finding the starts takes work in proportion to the rows (times
    the logarithm of the number of chunks) up to ``chunk_rows * FAN**2`` rows of one key, see
    ``_start_by_ranges``. Whether there are any is asked in a small job. Rows with a null key get
    null stats. Each pass reads only columns of ``df``; as that is read a few times, it should be a
    scan of stored data.
    """
    out = df
    for one in passes:
        out = _expand(df, out, one, chunk_rows)
    return out


def _expand(base: DataFrame, out: DataFrame, one: Expanding, chunk_rows: int) -> DataFrame:
    keys, value, columns = list(one.keys), one.value, out.columns
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    chunk = F.floor(one.index / chunk_rows)
    start = _chunk_start(base.where(named).select(*keys, value, chunk.alias("__chunk")), value, keys, chunk_rows)
    rows = out.select(
        # rows without a key need not meet
        "*", F.when(named, chunk).otherwise(F.pmod(F.xxhash64(*one.order), F.lit(1024))).alias("__chunk"),
        F.when(named, F.col(value)).alias("__v"), F.lit(1).alias("__row"),
    )
    for name, kind in (("__low", out.schema[value].dataType.simpleString()), ("__n", "bigint"), ("__sum", "double")):
        rows = rows.withColumn(name, F.lit(None).cast(kind))
    if start is not None:
        rows = rows.unionByName(start.withColumn("__low", F.col("__v")), allowMissingColumns=True)
    line = Window.partitionBy(*keys, "__chunk").orderBy("__row", "__low", *one.order)
    rows = rows.select("*", (F.row_number().over(line) == 1).alias("__first"))
    kinds = {"min": out.schema[value].dataType, "max": out.schema[value].dataType}
    found = [StructField(f"__{s}_so_far", kinds.get(s, DoubleType())) for s in one.names]
    stats = rows.mapInArrow(_so_far_stats(columns, list(one.names), chunk_rows), StructType([*out.schema.fields, *found]))
    return stats.select(*columns, *[F.col(f"__{s}_so_far").alias(n) for s, n in one.names.items()])


def _so_far_stats(columns: list[str], names: list[str], chunk_rows: int):
    """A function over sorted rows of whole chunks: the rows with the stats of their chunk so far.

    A chunk begins at ``__first``, with its start (``__row`` 0: values in order, how often each, and
    the sum of each), if it has any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, low, high, n, total, least, most = [], [], [], 0, 0, None, None
        stats = dict.fromkeys(("min", "max", "avg", "median"))
        for batch in batches:
            read = [batch.column(c).to_pylist() for c in ("__first", "__row", "__v", "__n", "__sum")]
            own, results = [], {s: [] for s in names}
            for i, (first, row, v, times, of) in enumerate(zip(*read)):
                if first:
                    start, low, high, n, total, least, most = [], [], [], 0, 0, None, None
                    stats = dict.fromkeys(stats)
                if not row:
                    start.append((v, times))
                    n, total = n + times, total + of
                    continue
                if start:
                    least, most = start[0][0], start[-1][0]
                    low, high = _halves(start, n, chunk_rows)
                    start = []
                    stats = _stats_of(low, high, n, total, least, most)
                if v is not None:
                    n, total = n + 1, total + v
                    if n % 2:
                        heappush(low, -heappushpop(high, v))
                    else:
                        heappush(high, -heappushpop(low, -v))
                    if least is None:
                        least = most = v
                    elif v < least:
                        least = v
                    elif v > most:
                        most = v
                    stats = _stats_of(low, high, n, total, least, most)
                own.append(i)
                for s, found in results.items():
                    found.append(stats[s])
            kept = batch.select(columns).take(pa.array(own, pa.int64()))
            types = {"min": batch.schema.field("__v").type, "max": batch.schema.field("__v").type}
            new = [pa.array(found, types.get(s, pa.float64())) for s, found in results.items()]
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], [*columns, *[f"__{s}_so_far" for s in names]])

    return run


def _stats_of(low: list, high: list, n: int, total, least, most) -> dict:
    """The stats of ``n`` values; ``low`` holds the lower half of them, negated, ``high`` the upper."""
    median = -low[0] if n % 2 else 0.5 * high[0] - 0.5 * low[0]
    return {"min": least, "max": most, "avg": total / n, "median": float(median)}


def _halves(start: list[tuple], n: int, chunk_rows: int) -> tuple[list, list]:
    """The lower half of the values in ``start`` (value, how often; ascending), negated, and the upper
    half, as heaps. Of each only what a chunk's rows can bring to the middle."""
    low, high, at, half, reach = [], [], 0, n - n // 2, chunk_rows // 2 + 2
    for v, times in start:
        below = max(0, min(at + times, half) - max(at, half - reach))
        above = max(0, min(at + times, half + reach) - max(at, half))
        low += [-v] * below
        high += [v] * above
        at += times
    return low[::-1], high


def _chunk_start(chunked: DataFrame, value: str, keys: list[str], chunk_rows: int, few: int = FEW_CHUNKS) -> DataFrame | None:
    """What lies before each chunk but the first, None if no key has a second one.

    Both ways give the same frames: one repeats each value in every later chunk, which is fast for
    short histories, the other takes work in proportion to the rows.
    """
    most = chunked.agg(F.max("__chunk")).first()[0]
    if not most:
        return None
    return (_start_by_values if most <= few else _start_by_ranges)(chunked, value, keys, chunk_rows)


def _start_by_values(chunked: DataFrame, value: str, keys: list[str], chunk_rows: int) -> DataFrame:
    """Value counts of all rows before each chunk but the first, each value once per later chunk."""
    last = (
        chunked.groupBy(*keys).agg(F.max("__chunk").alias("__last")).where("__last > 0")
    )
    counts = (
        chunked.where(F.col(value).isNotNull())
        .groupBy(*keys, "__chunk", F.col(value).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .join(last, keys)
    )
    same_value = Window.partitionBy(*keys, "__v").orderBy("__chunk")
    until = F.coalesce(F.lead("__chunk").over(same_value), "__last")
    seen = (
        counts.select(
            *keys, "__v", "__chunk", until.alias("__until"),
            F.sum("__n").over(_so_far(same_value)).alias("__n"),
        )
        .where("__chunk < __until")
        .select(
            *keys, "__v", "__n",
            F.explode(F.sequence(F.col("__chunk") + 1, F.col("__until"))).alias("__chunk"),
        )
    )
    by_value = Window.partitionBy(*keys, "__chunk").orderBy("__v")
    ranked = seen.withColumns(
        {
            "__hi": F.sum("__n").over(_so_far(by_value)),
            "__all": F.sum("__n").over(Window.partitionBy(*keys, "__chunk")),
        }
    )
    low, high = (F.col("__all") - chunk_rows) / 2 - 2, (F.col("__all") + chunk_rows) / 2 + 2
    side = F.when(F.col("__hi") < low, -1).when(F.col("__hi") - F.col("__n") > high, 1).otherwise(0)
    kept = F.when(F.col("__side") == 0, F.col("__v"))
    return (
        ranked.withColumn("__side", side)
        .groupBy(*keys, "__chunk", "__side", kept.alias("__kept"))
        .agg(
            F.sum("__n").alias("__n"),
            F.sum(F.col("__v") * F.col("__n")).alias("__sum"),
            F.when(F.col("__side") > 0, F.max("__v")).otherwise(F.min("__v")).alias("__v"),
        )
        .select(*keys, "__chunk", "__v", "__n", "__sum", F.lit(0).alias("__row"))
    )


def _start_by_ranges(chunked: DataFrame, value: str, keys: list[str], chunk_rows: int) -> DataFrame:
    """What lies before each chunk but the first: the values that its medians can reach, each with
    its count, and one entry for all below and one for all above.

    The values of a key are cut into FAN ranges, each of these into FAN again. Going down from all
    values, each chunk counts what came before it in the ranges of two nodes only, those that hold
    the lowest and the highest rank its medians can reach, so a level takes 2 * FAN rows per chunk.
    Then the ranges between the two are opened; a range holds few rows, and an early chunk, which
    opens many, has few rows before it.
    """
    key = [f"__k{i}" for i in range(len(keys))]
    named = chunked.where(F.col(value).isNotNull()).select(*[F.col(k).alias(n) for k, n in zip(keys, key)], "__chunk", F.col(value).alias("__v"))
    last = chunked.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, key)]).agg(F.max("__chunk").alias("__last")).where("__last > 0")
    counts = named.groupBy(*key, "__chunk", "__v").agg(F.count(F.lit(1)).alias("__n")).join(last, key)
    steps = F.array(*[F.lit(i / FAN) for i in range(1, FAN)])

    def cut(rows: DataFrame, node: list[str], name: str) -> DataFrame:
        """Add the value's range below its node; equal values share one."""
        cuts = rows.groupBy(*node).agg(F.percentile_approx(F.col("__v").cast("double"), steps, 10 * FAN).alias("__cuts"))
        below = F.size(F.filter("__cuts", lambda c: c < F.col("__v").cast("double")))
        return rows.join(cuts, node).withColumn(name, below).drop("__cuts")

    counts = cut_lineage(cut(cut_lineage(cut(cut_lineage(counts), key, "__a")), [*key, "__a"], "__b"))
    # per chunk: how many values came before it, their sum and extremes
    total = counts.groupBy(*key, "__chunk").agg(
        F.sum("__n").alias("__n"), F.sum(F.col("__v") * F.col("__n")).alias("__sum"), F.min("__v").alias("__min"), F.max("__v").alias("__max")
    )
    chunks = last.select(*key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__last"))).alias("__chunk"))
    past = Window.partitionBy(*key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.join(total, [*key, "__chunk"], "left").select(
        *key, "__chunk", *[f("__" + c).over(past).alias("__" + c) for c, f in (("n", F.sum), ("sum", F.sum), ("min", F.min), ("max", F.max))]
    ).where("__n > 0")
    before = cut_lineage(before)
    # the ranks, from 1, that the medians of the chunk's rows can need
    low = F.greatest(F.floor((F.col("__n") - chunk_rows) / 2) - 1, F.lit(1))
    high = F.least(F.ceil((F.col("__n") + chunk_rows) / 2) + 2, F.col("__n"))
    asked = before.select(*key, "__chunk", F.explode(F.array(low, high)).alias("__rank"), F.lit(0).cast("long").alias("__base")).distinct()
    down = _down(counts, cut_lineage(_down(counts, cut_lineage(asked), key, [], "__a")), key, ["__a"], "__b")
    ends = down.groupBy(*key, "__chunk").agg(
        *[f(F.struct("__rank", "__a", "__b", "__base")).alias(n) for f, n in ((F.min, "__low"), (F.max, "__high"))]
    )
    leaf = lambda e: F.col(f"{e}.__a") * FAN + F.col(f"{e}.__b")
    ends = cut_lineage(ends)
    opened = ends.select(*key, F.col("__chunk").alias("__at"), F.explode(F.sequence(leaf("__low"), leaf("__high"))).alias("__leaf"))
    kept = (
        counts.withColumn("__leaf", F.col("__a") * FAN + F.col("__b")).join(opened, [*key, "__leaf"]).where("__chunk < __at")
        .groupBy(*key, F.col("__at").alias("__chunk"), "__v").agg(F.sum("__n").alias("__n"))
    )
    kept = cut_lineage(kept)
    inner = kept.groupBy(*key, "__chunk").agg(F.sum("__n").alias("__in"), F.sum(F.col("__v") * F.col("__n")).alias("__in_sum"))
    rest = before.join(inner, [*key, "__chunk"]).join(ends.select(*key, "__chunk", F.col("__low.__base").alias("__below")), [*key, "__chunk"])
    above = F.col("__n") - F.col("__in") - F.col("__below")
    left = F.col("__sum") - F.col("__in_sum")
    outer = rest.select(*key, "__chunk", F.inline(F.array(
        F.struct(F.col("__min").alias("__v"), F.col("__below").alias("__n"), F.when(F.col("__below") > 0, left).otherwise(left * 0).alias("__sum")),
        F.struct(F.col("__max").alias("__v"), above.alias("__n"), F.when(F.col("__below") > 0, left * 0).otherwise(left).alias("__sum")),
    ))).where("__n > 0")
    both = kept.select(*key, "__chunk", "__v", "__n", (F.col("__v") * F.col("__n")).alias("__sum")).unionByName(outer)
    return both.select(*[F.col(n).alias(k) for k, n in zip(keys, key)], "__chunk", "__v", "__n", "__sum", F.lit(0).alias("__row"))


def _down(counts: DataFrame, asked: DataFrame, key: list[str], node: list[str], child: str) -> DataFrame:
    """One level down: the range ``child`` below ``node`` that holds each asked rank.

    ``__base`` becomes the number of values before the chunk that lie below that range. What came
    before a chunk in a range is a running sum in which the asking rows stand between the counts, so
    rows and questions meet without being paired.
    """
    inside = [*key, *node]
    events = counts.groupBy(*inside, child, "__chunk").agg(F.sum("__n").alias("__n")).withColumn("__asks", F.lit(1))
    every = F.explode(F.sequence(F.lit(0), F.lit(FAN - 1))).alias(child)
    questions = asked.select(*inside, "__chunk").distinct().select(*inside, "__chunk", every, F.lit(0).cast("long").alias("__n"), F.lit(0).alias("__asks"))
    along = Window.partitionBy(*inside, child).orderBy("__chunk", "__asks").rowsBetween(Window.unboundedPreceding, 0)
    held = events.unionByName(questions).withColumn("__held", F.sum("__n").over(along)).where("__asks = 0")
    up = Window.partitionBy(*inside, "__chunk").orderBy(child)
    spans = held.select(*inside, "__chunk", child, "__held", F.sum("__held").over(up.rowsBetween(Window.unboundedPreceding, 0)).alias("__upto"))
    met = asked.join(spans, [*inside, "__chunk"])
    first = F.col("__base") + F.col("__upto") - F.col("__held")
    here = (F.col("__rank") > first) & (F.col("__rank") <= F.col("__base") + F.col("__upto"))
    return met.where(here).select(*inside, child, "__chunk", "__rank", first.alias("__base"))
