"""The test tables in the roles of the pipeline's input tables.

Orders are shows, customers venues, nations states, brands songs, line items the setlist rows,
and some parts albums. Orders after ``LAST_SETLIST`` are announced but not yet played.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.columns import lookup_key, replace_where
from panelcast.operators.lookup import lookup_chain
from panelcast.operators.order import keep_first
from panelcast.params import PanelParams
from panelcast.sources.tables import read_table

LAST_SETLIST = "2001-06-30"

PARAMS = PanelParams(
    max_run_gap=120,
    previous_year={1998: 1996},
    trailing_overrides={1998: 36, 1999: 24},
    notebook_size=6,
    source_order=("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"),
    family="LARGE",
    aliases={"PROMO": "LARGE"},
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the names of their nation and region."""
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    quarter = F.year(day) * 10 + F.quarter(day)
    return (
        table(spark, sf_dir, "orders")
        .join(places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("showid"),
            day.alias("showdate"),
            F.year(day).alias("showyear"),
            F.month(day).alias("showmonth"),
            F.dayofmonth(day).alias("showday"),
            F.when(F.col("c_acctbal") < 0, 2).otherwise(1).alias("artistid"),
            F.when(F.col("o_totalprice") < 5000, 1).otherwise(0).alias("exclude_from_stats"),
            F.col("o_custkey").alias("venueid"),
            F.when(F.col("o_orderstatus") == "P", 61)
            .when(F.col("o_orderpriority") != "5-LOW", quarter)
            .cast("long")
            .alias("tourid"),
            F.col("c_name").alias("venue"),
            F.col("n_name").alias("city"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("n_name")).alias("state"),
            F.col("r_name").alias("country"),
        )
    )


def song_of(brand: str = "p_brand"):
    return F.substring_index(brand, "#", -1).cast("long")


def setlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the shows that have been played."""
    played = table(spark, sf_dir, "orders").where(
        F.col("o_orderdate").cast("date") <= F.lit(LAST_SETLIST).cast("date")
    )
    rows = all_setlists(spark, sf_dir)
    return rows.join(played.select(F.col("o_orderkey").alias("showid")), "showid", "left_semi")


def all_setlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a setlist row, whatever its day."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("showid"),
            song_of().alias("songid"),
            F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("is_original"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("isjamchart"),
            *PARAMS.source_order,
        )
    )


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per brand; its artist is the type of its first part."""
    parts = table(spark, sf_dir, "part").select(
        song_of().alias("songid"), F.col("p_brand").alias("song"), F.col("p_type").alias("artist"),
        "p_partkey",
    )
    return keep_first(parts, ["songid"], ["p_partkey"]).drop("p_partkey")


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as an album of its brand."""
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") % 2400).cast("int"))
    return table(spark, sf_dir, "part").select(
        song_of().alias("songid"), F.col("p_partkey").alias("albumid"), day.alias("releasedate"),
        "p_type", "p_size",
    )


def albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small promo parts only, so that some brands have no album."""
    return releases(spark, sf_dir).where("p_type = 'PROMO' AND p_size <= 10").drop("p_type", "p_size")


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues before cleaning."""
    return places(spark, sf_dir).select(
        F.col("c_custkey").alias("venueid"),
        F.col("c_mktsegment").alias("venuename"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit("S-"), "n_name")).alias("state"),
        F.col("r_name").alias("country"),
        "c_acctbal",
    )


def keyed_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues with cleaned names and both lookup keys; rows without a key are dropped."""
    clean = replace_where(venues(spark, sf_dir), "venuename", {"BUILDING": "Unknown"})
    clean = replace_where(clean, "city", {"NATION_1": "NATION_2"}).where("city != 'NATION_3'")
    return clean.withColumns(
        {
            "lookup_id": lookup_key(
                "venuename", "city", "state", "country",
                unknown={"venuename": "Unknown"}, optional=["state"],
            ),
            "lookup_id2": lookup_key("city", "state", "country", optional=["state"]),
        }
    ).where("lookup_id IS NOT NULL")


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates: full keys of the venues in credit, and "state, country" cities of most nations."""
    full = keyed_venues(spark, sf_dir).where("c_acctbal > 5000").groupBy("lookup_id").agg(
        F.min("c_acctbal").alias("latitude"), F.max("c_acctbal").alias("longitude")
    )
    city = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .where("n_nationkey > 5")
        .select(
            F.concat_ws(", ", "n_name", F.concat(F.lit("S-"), "n_name"), "r_name").alias("place"),
            (F.col("n_nationkey") * 3.0 - 40).alias("latitude"),
            (F.col("n_nationkey") * 5.0 - 60).alias("longitude"),
        )
    )
    return full.withColumnRenamed("lookup_id", "place").unionByName(city)


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues located through the gazetteer, by the full key or else by the city."""
    located = lookup_chain(
        keyed_venues(spark, sf_dir), gazetteer(spark, sf_dir), ["lookup_id", "lookup_id2"], "place",
        ["latitude", "longitude"],
    )
    return located.select("venueid", "latitude", "longitude")
