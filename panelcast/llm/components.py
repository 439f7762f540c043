"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.runtime import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``links``: (a, b) longs. Returns (node, root) for every linked node but the roots.

    The root is the smallest node of the component. Each round hangs larger neighbours, then the
    node itself, under the smallest neighbour; rounds grow with the logarithm of the longest path.
    Only a count and a checksum per round reach the driver. Null ends and loops are ignored.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars = cut_lineage(links.where("a <> b").select(high, low).distinct())
    seen = None
    while True:
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now[0] == 0 or now == seen:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut_lineage(large.where("a <> b").distinct())
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        stars = cut_lineage(moved.union(down).distinct())
