"""Mixing sources to target weights by capped water-filling. DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.words import word_count
from panelcast.runtime import cut_lineage


@dataclass(frozen=True)
class Mix:
    """Shares: ``budget`` times all words, dealt by ``weights`` over the sources in order.

    A source gives at most ``max_epochs`` times its own words. ``seed`` orders the documents whose
    last repetition is taken or not.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    budget: float = 1.5
    max_epochs: int = 2
    seed: str = "mix"
    bin_bits: int = 10


def water_filled(sources: DataFrame, mix: Mix) -> DataFrame:
    """Targets of (source, source_size): clamp at the cap, reshare what is over by weight, repeat.

    Each round clamps the sources whose share is above their cap; the shares of the rest only grow,
    so a clamped source stays clamped and there are at most as many rounds as sources. The order by
    code point (null last) numbers the sources in one window: one row per source.
    """
    ranked = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    table = cut_lineage(
        sources.withColumn("weight", F.get(weights, ranked % len(mix.weights))).withColumn(
            "cap", (F.col("source_size") * mix.max_epochs).cast("double")
        )
    )
    total = float(table.agg(F.sum("source_size")).first()[0] or 0) * mix.budget
    share, clamped = 0.0, -1
    while True:
        # sources at their cap under the present share, and what they leave
        over = F.col("cap") <= share * F.col("weight") if clamped >= 0 else F.lit(False)
        used, rest, count = table.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(over, 1)),
        ).first()
        if count == clamped:
            break
        clamped = count
        share = (total - used) / rest if rest else float("inf")
        if not rest:
            break
    at_cap = F.col("cap") <= F.lit(share) * F.col("weight")
    target = F.when(at_cap, F.col("cap")).otherwise(F.lit(share) * F.col("weight"))
    return table.withColumn("target", F.when(F.lit(share == float("inf")), F.col("cap")).otherwise(target))


DRAW_BITS = 60


def draw(seed: str, doc_id: Column) -> Column:
    """A seeded number from 0 to 2^60 - 1 for a document."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.lit(":"), doc_id.cast("string"))), 1, 15), 16, 10).cast("long")


def mixed(docs: DataFrame, mix: Mix = Mix(), carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, repeats, taken) of every row of ``docs``.

    Whole repetitions of a source are taken of all its documents. For the fraction left, documents
    go in the order of their seeded draw (ties by doc_id, then size; null doc_id last) and one is
    taken again if half of it still fits, so a source misses its target by less than half a document.
    Sizes before a document are sums per bin of the draw plus a window inside its bin, so no window
    holds a source. Null source is a source; null and empty texts have size 0; an empty source has
    target 0. ``taken`` counts words with repetitions. Columns named in ``carry`` come along; they are
    read from ``docs`` again rather than stored, so ``docs`` should be a table or a stored stage.
    """
    bin_of = F.shiftright(draw(mix.seed, F.col("doc_id")), DRAW_BITS - mix.bin_bits).cast("int")
    bin_of = F.coalesce(bin_of, F.lit(1 << mix.bin_bits))
    measured = [F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"), bin_of.alias("bin")]
    sized = cut_lineage(docs.select(*measured))
    bins = cut_lineage(sized.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")))
    sources = bins.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    targets = water_filled(sources, mix).select(F.col("source").alias("s"), "source_size", "target")
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    # stored: with its size known, Spark broadcasts it if small and does not shuffle the documents
    edges = cut_lineage(
        bins.withColumn("low", F.coalesce(F.sum("bin_size").over(before), F.lit(0).cast("long")))
        .join(targets, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("whole", whole)
        .withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("s", F.col("bin").alias("b"), "low", "bin_size", "source_size", "target", "whole", "extra")
    )
    # one bin of each source is cut by the fraction; documents of the others need no order
    here = F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))
    wide = docs.select(*measured, *[F.col(c).alias(f"_{c}") for c in carry]) if carry else sized
    rows = wide.join(edges, here)
    cut = (F.col("extra") >= F.col("low")) & (F.col("extra") < F.col("low") + F.col("bin_size"))
    order = Window.partitionBy("source", "bin").orderBy(
        F.col("doc_id").isNull(), draw(mix.seed, F.col("doc_id")), "doc_id", "size"
    ).rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.where(cut).withColumn("past", F.col("low") + F.coalesce(F.sum("size").over(order), F.lit(0).cast("long")))
    inside = inside.withColumn("again", (2 * F.col("past") + F.col("size") <= 2 * F.col("extra")).cast("long"))
    outside = rows.where(~cut).withColumn("again", (F.col("low") + F.col("bin_size") <= F.col("extra")).cast("long"))
    repeats = F.col("whole") + F.when(F.col("extra") > 0, F.col("again")).otherwise(0)
    columns = ["doc_id", "source", "size", "source_size", "target", repeats.alias("repeats")]
    columns += [F.col(f"_{c}").alias(c) for c in carry]
    out = outside.select(*columns).unionByName(inside.select(*columns))
    return out.withColumn("taken", F.col("repeats") * F.col("size"))
