"""The registered queries: each operator on the test tables, with its SQL for comparison."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions import columns as C
from panelcast.operators import history as H
from panelcast.operators import lookup as L
from panelcast.operators import order as O
from panelcast.operators import panel as N
from panelcast.operators import periods as D
from panelcast.operators import ranges as G
from panelcast.operators import trailing as T
from panelcast.operators.scan import STATS
from panelcast.plans import digest
from panelcast.plans import oracle as Q
from panelcast.plans import panel_plan as P
from panelcast.plans import roles as R
from panelcast.plans.oracle import over, real, sql, whole
from panelcast.runtime import cut_lineage
from panelcast.sources.tables import explode_envelope

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_BUILDS: dict[tuple[str, str], P.PanelBuild] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def build(spark: SparkSession, sf: str) -> P.PanelBuild:
    """The stored stages of this session, shared by the queries that start from them."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _BUILDS:
        _BUILDS[key] = P.PanelBuild(
            R.shows(spark, sf), R.setlists(spark, sf), R.songs(spark, sf), R.albums(spark, sf), R.PARAMS
        )
    return _BUILDS[key]


def forget_builds() -> None:
    _BUILDS.clear()
    model_queries.SETS.clear()


def six_digits(c: str):
    """Rounded just before the half, so that shares like 41/640 do not depend on the engine."""
    return F.floor(F.col(c).cast("double") * 1e6 + 0.5001) / 1e6


def tidy(df: DataFrame, *names: str) -> DataFrame:
    """Whole numbers as long and doubles with six digits, as in the SQL."""
    kinds = dict(df.dtypes)
    long, double = {"tinyint", "smallint", "int", "bigint"}, {"float", "double"}

    def shape(c: str):
        if kinds[c] in long:
            return F.col(c).cast("long").alias(c)
        if kinds[c] in double or kinds[c].startswith("decimal"):
            return six_digits(c).alias(c)
        return F.col(c)

    return df.select(*[shape(c) for c in (names or df.columns)])


def shows_(spark, sf):
    return P.eligible(R.shows(spark, sf), R.PARAMS)


# --- projection, filters, conditional columns -------------------------------------------------

@query("scan_filter_project", sql(f"SELECT {whole('showid', 'venueid', 'showyear')}, showdate FROM elig"))
def _(spark, sf):
    kept = R.shows(spark, sf).where("artistid = 1 AND exclude_from_stats = 0")
    return tidy(kept.drop("tourid"), "showid", "venueid", "showyear", "showdate")


@query("null_predicates", sql(
    f"SELECT {whole('showid', 'tourid')}, state FROM shows WHERE (tourid IS NULL OR tourid = 61) "
    "AND (state IS NOT NULL OR showyear > 1998)"))
def _(spark, sf):
    none = F.col("tourid").isNull() | (F.col("tourid") == 61)
    rows = R.shows(spark, sf).where(none & (F.col("state").isNotNull() | (F.col("showyear") > 1998)))
    return tidy(rows, "showid", "tourid", "state")


@query("clean_values", sql(f"SELECT {whole('venueid')}, venuename, city FROM venues_raw"))
def _(spark, sf):
    named = C.replace_where(R.venues(spark, sf), "venuename", {"BUILDING": "Unknown"})
    clean = C.replace_where(named, "city", {"NATION_1": "NATION_2"}).where("city != 'NATION_3'")
    return tidy(clean, "venueid", "venuename", "city")


@query("case_when_nested", sql(f"""SELECT {whole('showid')}, CASE WHEN tourid IS NOT NULL THEN
  CASE WHEN tourid = 61 THEN 'none' ELSE CASE WHEN showmonth > 6 THEN 'late' ELSE 'early' END END
  ELSE 'run' END AS kind FROM shows"""))
def _(spark, sf):
    half = F.when(F.col("showmonth") > 6, "late").otherwise("early")
    tour = F.when(F.col("tourid") == 61, "none").otherwise(half)
    kind = F.when(F.col("tourid").isNotNull(), tour).otherwise("run")
    return R.shows(spark, sf).select("showid", kind.alias("kind"))


@query("coalesce_fallback", sql(f"SELECT {whole('showid')}, coalesce(state, country) AS state FROM shows"))
def _(spark, sf):
    return R.shows(spark, sf).select("showid", F.coalesce("state", "country").alias("state"))


@query("fill_sentinel", sql(
    f"SELECT {whole('showid')}, CAST(coalesce(tourid, -1) AS BIGINT) AS tourid, "
    "CAST(coalesce(time_since_last_venue, 0) AS BIGINT) AS gap FROM hist"))
def _(spark, sf):
    gaps = H.lag_gap(shows_(spark, sf), ["venueid"], "showdate", "showid", "gap")
    return tidy(C.fill_sentinel(C.fill_sentinel(gaps, 0, ["gap"]), -1, ["tourid"]), "showid", "tourid", "gap")


@query("lookup_key", sql(f"SELECT {whole('venueid')}, lookup_id, lookup_id2 FROM venue_keys"))
def _(spark, sf):
    return R.keyed_venues(spark, sf).select("venueid", "lookup_id", "lookup_id2")


@query("map_values", sql(f"""SELECT {whole('p_partkey')},
  CASE p_type WHEN 'PROMO' THEN 'LARGE' WHEN 'SMALL' THEN 'MEDIUM' ELSE p_type END AS family FROM part"""))
def _(spark, sf):
    mapped = C.map_values(F.col("p_type"), {"PROMO": "LARGE", "SMALL": "MEDIUM"})
    return R.table(spark, sf, "part").select("p_partkey", mapped.alias("family"))


@query("is_cover", sql(f"SELECT {whole('showid', 'songid', 'is_cover')} FROM plays"))
def _(spark, sf):
    return tidy(build(spark, sf).plays, "showid", "songid", "is_cover")


@query("cast_features", sql("""SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_linenumber AS BIGINT)
  AS l_linenumber, CAST(l_partkey AS DOUBLE) AS l_partkey, l_quantity, l_returnflag FROM lineitem"""))
def _(spark, sf):
    rows = R.table(spark, sf, "lineitem")
    return C.cast_features(
        rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"), "l_linenumber"
    )


@query("union_by_name", sql("""SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name, CAST(NULL AS DOUBLE) AS price
FROM customer UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part"""))
def _(spark, sf):
    people = R.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    parts = R.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"), F.col("p_name").alias("name")
    )
    return people.unionByName(parts, allowMissingColumns=True)


@query("sorted_output", sql(
    f"SELECT {whole('showid', 'venueid')}, showdate, state FROM elig ORDER BY state, showdate DESC, showid"))
def _(spark, sf):
    rows = shows_(spark, sf).orderBy(F.asc("state"), F.desc("showdate"), "showid")
    return rows.select("showid", "venueid", "showdate", "state")


@query("json_envelope", sql("""SELECT CAST(event_id AS BIGINT) AS event_id,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""))
def _(spark, sf):
    payload = F.concat(F.lit('{"data": ['), "props", F.lit("]}")).alias("payload")
    return explode_envelope(R.table(spark, sf, "events").select("event_id", payload), "payload", "k long")


# --- calendar ---------------------------------------------------------------------------------

@query("calendar_features", sql(f"""SELECT {whole('showid')}, CAST({Q.season('showdate')} AS BIGINT) AS season,
  CAST(isodow(showdate) - 1 AS BIGINT) AS day_of_week,
  CAST(showdate - DATE '1983-10-01' AS BIGINT) AS time_since_formation FROM elig"""))
def _(spark, sf):
    dated = C.calendar_features(shows_(spark, sf), "showdate", R.PARAMS.epoch)
    return tidy(dated, "showid", "season", "day_of_week", "time_since_formation")


@query("season_bins", sql(f"""SELECT d AS showdate, CAST(month(d) * 100 + day(d) AS BIGINT) AS month_day,
  ['nye_run', 'winter', 'spring', 'summer', 'autumn'][{Q.season('d')} + 1] AS season
FROM (SELECT DISTINCT showdate AS d FROM shows)"""))
def _(spark, sf):
    day = F.col("showdate")
    rows = R.shows(spark, sf).select(day).distinct()
    return tidy(rows.select(day, C.month_day(day).alias("month_day"), C.season(day).alias("season")))


# --- joins ------------------------------------------------------------------------------------

@query("left_join_dim", sql(f"""SELECT {whole('l_orderkey', 'l_linenumber', 'l_partkey')}, p_brand, p_type
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 25"""))
def _(spark, sf):
    parts = R.table(spark, sf, "part").where("p_size > 25").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type"
    )
    rows = R.table(spark, sf, "lineitem").join(parts, "l_partkey", "left")
    return tidy(rows, "l_orderkey", "l_linenumber", "l_partkey", "p_brand", "p_type")


@query("left_join_composite", sql(f"""SELECT {whole('showid', 'songid', prefix='f.')},
  CAST(CASE WHEN j.showid IS NULL THEN 0 ELSE 1 END AS BIGINT) AS jammed
FROM plays f LEFT JOIN jgaps j ON f.showid = j.showid AND f.songid = j.songid"""))
def _(spark, sf):
    plays = build(spark, sf).plays
    jams = plays.where("isjamchart = 1").select("showid", "songid", F.lit(1).alias("jammed"))
    joined = plays.join(jams, ["showid", "songid"], "left").fillna(0, ["jammed"])
    return tidy(joined, "showid", "songid", "jammed")


@query("occurrence_join", sql(f"""SELECT {whole('showid', 'venueid', prefix='o.')}, CAST(songid AS BIGINT) AS songid,
  showdate, CAST(isjamchart AS BIGINT) AS isjamchart FROM elig o JOIN (
    SELECT l_orderkey AS showid, songid, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS isjamchart
    FROM lineitem JOIN brands ON l_partkey = p_partkey) s ON o.showid = s.showid"""))
def _(spark, sf):
    rows = shows_(spark, sf).select("showid", "showdate", "venueid").join(R.all_setlists(spark, sf), "showid")
    return tidy(rows, "showid", "venueid", "songid", "showdate", "isjamchart")


@query("panel_theta", sql(f"SELECT {whole('showid', 'songid', 'show_nm')}, showdate, song_debut_date FROM bare"))
def _(spark, sf):
    b = build(spark, sf)
    frame = P.panel_frame(b.plays, b.panel_shows)
    return tidy(frame, "showid", "songid", "show_nm", "showdate", "song_debut_date")


@query("asof_release", sql(f"""SELECT {whole('showid', 'songid', prefix='p.')}, showdate, releasedate,
  CAST(albumid AS BIGINT) AS albumid FROM plays p ASOF LEFT JOIN
  (SELECT songid, releasedate, max(albumid) AS albumid FROM releases GROUP BY ALL) r
  ON p.songid = r.songid AND p.showdate >= r.releasedate"""))
def _(spark, sf):
    found = L.asof_join(
        build(spark, sf).plays.select("showid", "songid", "showdate"), R.releases(spark, sf), ["songid"],
        "showdate", "releasedate", ["releasedate", "albumid"], id_col="showid",
    )
    return tidy(found)


@query("semi_min_support", sql(f"""SELECT {whole('showid', 'songid', 'venueid')} FROM plays
WHERE venueid IN (SELECT venueid FROM plays GROUP BY venueid HAVING sum(isjamchart) >= 20)"""))
def _(spark, sf):
    plays = build(spark, sf).plays
    return tidy(L.min_support(plays, plays, "venueid", "isjamchart", 20), "showid", "songid", "venueid")


@query("anti_incremental", sql(f"""SELECT {whole('venueid')}, lookup_id, CAST(1 AS BIGINT) AS fresh FROM located
WHERE venueid NOT IN (SELECT venueid FROM located WHERE latitude IS NOT NULL AND lookup_id = lookup_id2)
UNION ALL SELECT CAST(venueid AS BIGINT), NULL, NULL FROM located
WHERE latitude IS NOT NULL AND lookup_id = lookup_id2"""))
def _(spark, sf):
    todo = R.keyed_venues(spark, sf)
    # rows without a name are the ones that were looked up before
    before = R.coordinates(spark, sf).join(
        todo.where("lookup_id = lookup_id2").select("venueid"), "venueid", "left_semi"
    )
    resolved = F.col("latitude").isNotNull()
    fresh = L.unresolved(todo, before, "venueid", resolved)
    merged = L.incremental_merge(
        before, fresh.select("venueid", "lookup_id", F.lit(1).alias("fresh")), resolved
    )
    return tidy(merged, "venueid", "lookup_id", "fresh")


@query("join_dim_dedup", sql(f"""SELECT {whole('showid', 'songid', prefix='p.')}, artist
FROM plays p LEFT JOIN songs s ON p.songid = s.songid"""))
def _(spark, sf):
    parts = R.table(spark, sf, "part").select(
        R.song_of().alias("songid"), "p_partkey", F.col("p_type").alias("artist")
    )
    joined = L.join_dim(build(spark, sf).plays, parts, "songid", ["p_partkey"])
    return tidy(joined, "showid", "songid", "artist")


@query("lookup_chain", sql(f"SELECT {whole('venueid')}, {real('latitude', 'longitude')} FROM located"))
def _(spark, sf):
    return tidy(R.coordinates(spark, sf))


@query("next_occasion", sql(f"""SELECT {whole('showid', 'venueid', 'new_tourid', 'runid', 'prev_year',
  'prev_tourid', 'show_nm')}, showdate FROM pocc WHERE is_next = 1"""))
def _(spark, sf):
    b = build(spark, sf)
    ahead = P.panel_occasions(b.plays, b.occasions).where("is_next = 1")
    return tidy(ahead, "showid", "venueid", "new_tourid", "runid", "prev_year", "prev_tourid", "show_nm", "showdate")


# --- aggregates -------------------------------------------------------------------------------

@query("period_counts", sql("""SELECT CAST(new_tourid AS BIGINT) AS new_tourid, state, CAST(songid AS BIGINT) AS songid,
  count(*) AS times, CAST(sum(isjamchart) AS BIGINT) AS jams FROM plays GROUP BY ALL"""))
def _(spark, sf):
    counts = build(spark, sf).plays.groupBy("new_tourid", "state", "songid").agg(
        F.count(F.lit(1)).alias("times"), F.sum("isjamchart").alias("jams")
    )
    return tidy(counts)


@query("period_rates", sql(f"""SELECT {whole('new_tourid', 'songid')}, {real('rate')} FROM (
  SELECT new_tourid, songid, avg(played) AS rate FROM frame GROUP BY ALL)"""))
def _(spark, sf):
    return tidy(build(spark, sf).outcomes.groupBy("new_tourid", "songid").agg(F.avg("played").alias("rate")))


@query("period_gap_stats", sql(f"""SELECT {whole('songid', 'prev_year')},
  {real(*P.YEAR_PLAYS.values())} FROM year_plays"""))
def _(spark, sf):
    stats = D.gap_stats(build(spark, sf).scope_gaps(""), ["songid", "showyear"], "show_gap_song", P.YEAR_PLAYS)
    renamed = stats.withColumnRenamed("showyear", "prev_year")
    return tidy(renamed.select("songid", "prev_year", *[F.col(c).cast("double") for c in P.YEAR_PLAYS.values()]))


@query("distinct_keys", sql(f"SELECT DISTINCT {whole('prev_tourid', 'songid', 'venueid')} FROM frame WHERE prev_tourid IS NOT NULL"))
def _(spark, sf):
    keys = build(spark, sf).outcomes.select("prev_tourid", "songid", "venueid")
    return tidy(keys.where("prev_tourid IS NOT NULL").distinct())


_FIRST_LAST = """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_partkey AS BIGINT) AS l_partkey, l_returnflag
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber {0}, l_partkey {0},
  l_suppkey {0}, l_extendedprice {0}, l_shipdate {0}) = 1"""
_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


@query("keep_first", sql(_FIRST_LAST.format("ASC")))
def _(spark, sf):
    first = O.keep_first(R.table(spark, sf, "lineitem"), ["l_orderkey"], _LINE_ORDER)
    return tidy(first, "l_orderkey", "l_partkey", "l_returnflag")


@query("keep_last", sql(_FIRST_LAST.format("DESC")))
def _(spark, sf):
    last = O.keep_last(R.table(spark, sf, "lineitem"), ["l_orderkey"], _LINE_ORDER)
    return tidy(last, "l_orderkey", "l_partkey", "l_returnflag")


@query("period_bounds", sql(f"SELECT {whole('showid', 'new_tourid', 'days_left_on_tour', 'days_on_tour', 'tour_season', 'tour_show_number')} FROM occ"))
def _(spark, sf):
    names = ["showid", "new_tourid", "days_left_on_tour", "days_on_tour", "tour_season", "tour_show_number"]
    return tidy(build(spark, sf).occasions, *names)


@query("debut", sql(f"""SELECT {whole('showid', 'songid')}, CAST(showdate - song_debut_date AS BIGINT)
  AS time_since_song_debut FROM plays JOIN first_plays USING (songid) WHERE showdate > song_debut_date"""))
def _(spark, sf):
    plays = build(spark, sf).plays
    rows = plays.join(N.debuts(plays, "songid", "showdate", "first"), "songid")
    since = rows.withColumn("time_since_song_debut", F.datediff("showdate", "first"))
    return tidy(since.where("time_since_song_debut > 0"), "showid", "songid", "time_since_song_debut")


# --- order and history ------------------------------------------------------------------------

@query("lag_gap", sql(f"SELECT {whole('showid', 'venueid')}, CAST(time_since_last_venue AS BIGINT) AS gap FROM hist"))
def _(spark, sf):
    return tidy(H.lag_gap(shows_(spark, sf), ["venueid"], "showdate", "showid", "gap"), "showid", "venueid", "gap")


@query("lead_gap", sql(f"SELECT {whole('showid', 'venueid')}, CAST(showdate - lead(showdate) {over(['venueid'])} AS BIGINT) AS gap FROM elig"))
def _(spark, sf):
    return tidy(H.lead_gap(shows_(spark, sf), ["venueid"], "showdate", "showid", "gap"), "showid", "venueid", "gap")


@query("global_lag", sql(f"SELECT {whole('showid')}, showdate, lag(showdate) {over([])} AS before FROM elig"))
def _(spark, sf):
    return O.global_lag(shows_(spark, sf), "showdate", "showdate", "showid", "before").select(
        "showid", "showdate", "before"
    )


@query("running_count", sql(f"SELECT {whole('showid', 'num_show_venue')} FROM hist"))
def _(spark, sf):
    return tidy(
        H.running_count(shows_(spark, sf), ["venueid"], "showdate", "showid", "num_show_venue"),
        "showid", "num_show_venue",
    )


@query("expanding_stats", sql(f"""SELECT {whole('showid', 'songid')},
  {real('min_gap_song', 'max_gap_song', 'avg_gap_song')} FROM pf"""))
def _(spark, sf):
    gaps = build(spark, sf).scope_gaps("").select("showid", "songid", "showdate", "num_times_played_song", "gap_song")
    stats = H.expanding_by_scope(gaps, "songid", "showdate", "showid", {"gap_song": {"": ()}})
    return _doubles(stats, ["showid", "songid"], ["min_gap_song", "max_gap_song", "avg_gap_song"])


@query("expanding_median", sql(f"""SELECT {whole('showid', 'songid')}, {real('median')} FROM (SELECT showid, songid,
  median(gap_song_state) {over(['state', 'songid'], Q.ORDER, Q.SO_FAR)} AS median FROM gaps)"""))
def _(spark, sf):
    gaps = build(spark, sf).scope_gaps("_state").select(
        "showid", "songid", "state", "showdate", "num_times_played_song_state", "gap_song_state"
    )
    stats = H.expanding_by_scope(gaps, "songid", "showdate", "showid", {"gap_song": {"_state": ("state",)}})
    return _doubles(
        stats.withColumnRenamed("median_gap_song_state", "median"), ["showid", "songid"], ["median"]
    )


def _doubles(df: DataFrame, ids: list[str], values: list[str]) -> DataFrame:
    return tidy(df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values]))


@query("last_before", sql(f"""SELECT {whole('showid', 'songid')},
  CAST(showdate - {Q._before('played_day', ['songid'])} AS BIGINT) AS days_since_last_played,
  CAST({Q._before('num_times_played_song', ['songid'])} AS BIGINT) AS num_played_before FROM frame"""))
def _(spark, sf):
    return days_since_last(spark, sf, build(spark, sf))


def days_since_last(spark: SparkSession, sf: str, b: P.PanelBuild) -> DataFrame:
    """For each song at each occasion: days since it was last played, and how often before."""
    counts = H.running_count(b.plays, ["songid"], "showdate", "showid", "n", start=1)
    own = counts.select("showid", "songid", "showdate", "show_nm", F.struct(F.col("showdate").alias("day"), "n").alias("past"))
    past = P.panel_frame(b.plays, b.panel_shows, own, ("past",))
    return tidy(
        past.select(
            "showid", "songid", F.datediff("showdate", "past.day").alias("days_since_last_played"),
            F.col("past.n").alias("num_played_before"),
        )
    )


@query("ffill", sql(f"""SELECT {whole('showid')}, CAST(last_value(tourid IGNORE NULLS)
  {over(['venueid'], Q.ORDER, Q.SO_FAR)} AS BIGINT) AS tour FROM elig"""))
def _(spark, sf):
    filled = H.carry_forward(
        shows_(spark, sf), "tourid", ["venueid"], "showdate", "showid", "tour", include_row=True
    )
    return tidy(filled, "showid", "tour")


@query("global_ffill", sql(f"""SELECT {whole('showid')}, CAST(last_value(tourid IGNORE NULLS)
  {over([], Q.ORDER, Q.SO_FAR)} AS BIGINT) AS tourid FROM elig"""))
def _(spark, sf):
    return tidy(O.global_fill(shows_(spark, sf), "tourid", "showdate", "showid"), "showid", "tourid")


@query("runs_global", sql(f"SELECT {whole('showid', 'runid')} FROM inrun"))
def _(spark, sf):
    return tidy(D.runs(shows_(spark, sf), "venueid", "showdate", "showid", 120), "showid", "runid")


@query("runs_scope", sql(f"""SELECT {whole('showid')}, CAST(last_value(rn IGNORE NULLS)
  {over(['venueid'], Q.ORDER, Q.SO_FAR)} AS BIGINT) AS runid FROM numbered"""))
def _(spark, sf):
    found = D.runs(shows_(spark, sf), "venueid", "showdate", "showid", 120, inherit="scope")
    return tidy(found, "showid", "runid")


@query("occasion_number", sql(f"SELECT {whole('showid', 'show_nm')} FROM nums"))
def _(spark, sf):
    keys = build(spark, sf).plays.select("showdate", "showid")
    return tidy(O.ordinal(keys, "showdate", "showid", name="show_nm"), "showid", "show_nm")


# The same operators where ids are hashes, so that blocks of ids are no help.
_HASHED = "CAST('0x' || substr(md5(CAST(CAST(showid AS BIGINT) AS VARCHAR)), 1, 15) AS BIGINT)"


def _hashed_shows(spark, sf):
    key = F.conv(F.substring(F.md5(F.col("showid").cast("long").cast("string")), 1, 15), 16, 10).cast("long")
    return shows_(spark, sf).select(key.alias("hashed"), "showdate", "tourid")


@query("ordinals_of_hashed_ids", sql(f"""SELECT hashed, CAST(row_number() OVER w AS BIGINT) AS number, lag(showdate) OVER w AS before,
  CAST(last_value(tourid IGNORE NULLS) OVER w AS BIGINT) AS filled FROM (SELECT *, {_HASHED} AS hashed FROM elig)
  WINDOW w AS (ORDER BY showdate, hashed ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def _(spark, sf):
    """Number, previous day and filled tour of every show in the order of day and a hashed id."""
    out = G.running(_hashed_shows(spark, sf), ["showdate", "hashed"], {"number": 1}, {"before": "showdate"}, {"filled": "tourid"})
    return tidy(out, "hashed", "number", "before", "filled")


@query("previous_period", sql(f"SELECT {whole('new_tourid', 'prev_tourid')} FROM trs "
                              "UNION ALL SELECT showyear, prev_year FROM yrs"))
def _(spark, sf):
    plays = build(spark, sf).plays
    tours = O.previous_period(plays, "new_tourid", "prev_tourid")
    years = O.previous_period(plays, "showyear", "prev_year", R.PARAMS.previous_year)
    return tidy(tours.union(years))


@query("show_gap", sql(f"SELECT {whole('showid', 'songid', 'show_gap_song')}, "
                       f"{real(*[f'{s}_show_gap_song' for s in STATS])} FROM pf"))
def _(spark, sf):
    stats = [f"{s}_show_gap_song" for s in STATS]
    return _doubles(P.show_gap_stats(build(spark, sf).scope_gaps("")), ["showid", "songid", "show_gap_song"], stats)


@query("scope_history", sql(f"""SELECT {whole('showid', 'num_show_venue', 'time_since_last_venue',
  'num_show_state', 'time_since_last_state', 'show_number', 'time_since_last_show')} FROM hist"""))
def _(spark, sf):
    out = H.scope_history(shows_(spark, sf), {"venue": "venueid", "state": "state"}, "showdate", "showid")
    return tidy(out, "showid", "num_show_venue", "time_since_last_venue", "num_show_state",
                "time_since_last_state", "show_number", "time_since_last_show")


@query("unified_period", sql(f"SELECT {whole('showid', 'new_tourid')} FROM placed"))
def _(spark, sf):
    numbered = D.unified_period(
        build(spark, sf).occasions.drop("new_tourid"), "tourid", "runid", "showdate", "showid", 61
    )
    return tidy(numbered, "showid", "new_tourid")


_SCOPE_STATS = [f"{k}_gap_song{s}" for s in P.SCOPES for k in STATS]


@query("scope_gap_stats", sql(f"""SELECT {whole('showid', 'songid', *[f'num_times_played_song{s}' for s in P.SCOPES])},
  {real(*_SCOPE_STATS)} FROM pf"""))
def _(spark, sf):
    ids = ["showid", "songid", *[f"num_times_played_song{s}" for s in P.SCOPES]]
    b = build(spark, sf)
    plays = b.plays.select(P.PLAY, "showid", "songid")
    return _doubles(P.play_features(plays, {s: P.scope_stats(b.scope_gaps(s), s, shows=False) for s in P.SCOPES}), ids, _SCOPE_STATS)


# --- panel features ---------------------------------------------------------------------------

_RECENCY_WHOLE = [f"{c}{s}" for c in ("time_last_played_song", "num_times_played_song") for s in P.SCOPES]


@query("panel_recency", sql(f"""SELECT {whole('showid', 'songid', *_RECENCY_WHOLE)},
  {real(*_SCOPE_STATS)} FROM rec"""))
def _(spark, sf):
    return _doubles(build(spark, sf).recent, ["showid", "songid", *_RECENCY_WHOLE], _SCOPE_STATS)


_JAM_STATS = [f"{k}_show_gap_j_song" for k in STATS]


@query("flagged_branch", sql(f"""SELECT {whole('showid', 'songid', 'isjamchart', 'show_gap', 'show_jam_gap',
  'n_times_jammed_song')}, {real(*_JAM_STATS, *[f'{k}_show_gap_song' for k in STATS])} FROM rec"""))
def _(spark, sf):
    ids = ["showid", "songid", "isjamchart", "show_gap", "show_jam_gap", "n_times_jammed_song"]
    b = build(spark, sf)
    out = P.flagged_recency(b.plays, b.panel_shows, P.show_gap_stats(b.scope_gaps("")), b.jam_stats)
    return _doubles(out, ids, [*_JAM_STATS, *[f"{k}_show_gap_song" for k in STATS]])


@query("active_flag", sql(f"SELECT {whole('showid', 'songid', 'played_in_last_year', 'jammed_in_last_year')} FROM rec"))
def _(spark, sf):
    b = build(spark, sf)
    return tidy(P.activity(b.plays, b.panel_shows), "showid", "songid", "played_in_last_year", "jammed_in_last_year")


@query("spine_fill", sql(f"SELECT {whole('prev_tourid', 'songid', 'num_times_song_played_state_last_tour')}, state FROM spine_state"))
def _(spark, sf):
    b, value = build(spark, sf), "num_times_song_played_state_last_tour"
    counts = b.plays.groupBy(F.col("new_tourid").alias("prev_tourid"), "songid", "state").agg(
        F.count(F.lit(1)).alias(value)
    )
    return tidy(
        D.spine_fill(b.outcomes, ["prev_tourid", "songid", "state"], counts, value),
        "prev_tourid", "songid", value, "state",
    )


@query("lagged_period_join", sql(f"""SELECT {whole('showid', 'songid', 'prev_year', prefix='f.')},
  {real('avg_show_gap_last_year_sng')} FROM frame f LEFT JOIN year_plays y
  ON f.songid = y.songid AND f.prev_year = y.prev_year"""))
def _(spark, sf):
    b = build(spark, sf)
    stats = D.gap_stats(
        b.scope_gaps(""), ["songid", "showyear"], "show_gap_song", {"avg": "avg_show_gap_last_year_sng"}
    )
    frame = b.outcomes.select("showid", "songid", "prev_year")
    return tidy(D.lagged_period_join(frame, stats, "showyear", "prev_year", ["songid"]))


def _tour_query(kind: str, cte: str, table: Callable):
    for scope, cols in P.TOUR_SCOPES.items():
        value, names = P._tour_names(kind, scope)
        values = [value, *names.values()]
        ids = whole("prev_tourid", "songid", *[c for c in cols if c != "state"])
        text = "".join(f", {c}" for c in cols if c == "state")

        def run(spark, sf, scope=scope, cols=cols, values=values):
            out = table(build(spark, sf), cols, scope)
            return _doubles(out, ["prev_tourid", "songid", *cols], values)

        query(f"{cte}{scope}", sql(f"SELECT {ids}{text}, {real(*values)} FROM {cte.split('_')[-1]}{scope}"))(run)


_tour_query("num_times_song_played", "prev_period_counts",
            lambda b, cols, scope: P.previous_tour_counts(b.outcomes, b.plays, cols, scope))
_tour_query("rate_song_played", "prev_period_rates",
            lambda b, cols, scope: P.previous_tour_rates(b.outcomes, cols, scope))


@query("prev_period_gap_stats", sql(f"""SELECT {whole('prev_tourid', 'songid', prefix='t.')},
  {real(*P.TOUR_PLAYS.values(), *P.TOUR_JAMS.values())} FROM tour_plays t LEFT JOIN tour_jams j
  ON t.songid = j.songid AND t.prev_tourid = j.prev_tourid"""))
def _(spark, sf):
    b = build(spark, sf)
    keys = ["songid", "new_tourid"]
    own = D.gap_stats(b.scope_gaps(""), keys, "show_gap_song", P.TOUR_PLAYS)
    flagged = D.gap_stats(b.jam_gaps, keys, "show_gap_j_song", P.TOUR_JAMS)
    out = own.join(flagged, keys, "left").withColumnRenamed("new_tourid", "prev_tourid")
    return _doubles(out, ["prev_tourid", "songid"], [*P.TOUR_PLAYS.values(), *P.TOUR_JAMS.values()])


@query("closed_previous_period", sql("""SELECT CAST(a.new_tourid AS BIGINT) AS new_tourid,
  CAST(arg_max(b.new_tourid, b.last * 1000000 + b.new_tourid) AS BIGINT) AS prev_tourid
FROM bounds a LEFT JOIN bounds b ON b.last < a.first GROUP BY a.new_tourid""", {
    "bounds": """SELECT new_tourid, min(showdate - DATE '1970-01-01') AS first,
  max(showdate - DATE '1970-01-01') AS last FROM occ GROUP BY new_tourid"""}))
def _(spark, sf):
    shows = build(spark, sf).occasions.select("new_tourid", "showdate")
    return tidy(D.closed_previous_period(shows, "new_tourid", "showdate", "prev_tourid"))


@query("trailing_year", sql(f"""SELECT {whole('showid', 'songid', 'tot_times_played_in_last_year',
  'tot_times_jammed_in_last_year')}, {real('rate_played_this_year', 'rate_jammed_this_year', 'avg_gap_year',
  'avg_jam_gap_year')} FROM rec JOIN trail USING (songid, showdate)"""))
def _(spark, sf):
    b = build(spark, sf)
    out = T.trailing_window(
        P.overall_gaps(b.plays, b.panel_shows), "songid", "showdate", P.TRAILING, R.PARAMS.trailing_months,
        R.PARAMS.trailing_overrides,
    )
    return tidy(out, "showid", "songid", *P.TRAILING)


def _past_year(rows: pd.DataFrame, days: pd.DataFrame) -> pd.DataFrame:
    """The trailing features of ``rows`` from sums per day: differences of running totals."""
    months = rows["showdate"].dt.year.map(R.PARAMS.trailing_overrides).fillna(R.PARAMS.trailing_months).astype(int)
    start = pd.Series(pd.NaT, index=rows.index, dtype="datetime64[ns]")
    for m in months.unique():
        start[months == m] = rows["showdate"][months == m] - pd.DateOffset(months=int(m))
    held = days["showdate"].to_numpy()
    a, b = (np.searchsorted(held, x.to_numpy()) for x in (start, rows["showdate"]))
    out = rows[["showid", "songid"]].copy()
    for i, (name, (kind, _)) in enumerate(P.TRAILING.items()):
        total, n = (np.concatenate([[0.0], np.cumsum(days[f"{part}{i}"])]) for part in ("s", "n"))
        total, n = total[b] - total[a], n[b] - n[a]
        out[name] = np.divide(total, n, out=np.full(len(n), np.nan), where=n > 0) if kind == "mean" else total
    return out


@query("trailing_map", ORACLES["trailing_year"])
def _(spark, sf):
    """The trailing features again, by a function of its own over each entity's stretches of days."""
    values = [F.expr(value).cast("double") for _, value in P.TRAILING.values()]
    per_day = {f"{part}{i}": F.coalesce(f(v), F.lit(0)).cast("double") for i, v in enumerate(values) for part, f in (("s", F.sum), ("n", F.count))}
    whole_numbers = [name for name, (kind, _) in P.TRAILING.items() if kind == "sum"]
    schema = "showid long, songid long, " + ", ".join(f"{name} double" for name in P.TRAILING)
    reach = 31 * max(R.PARAMS.trailing_months, *R.PARAMS.trailing_overrides.values())
    out = T.map_trailing(build(spark, sf).recent, "songid", "showdate", reach, per_day, _past_year, schema, ["showid"])
    return tidy(out.withColumns({c: F.col(c).cast("long") for c in whole_numbers}))


@query("topk_flag", sql(f"SELECT {whole('showid', 'songid', 'notebook_flag')} FROM flagged"))
def _(spark, sf):
    return tidy(P.notebook_flag(build(spark, sf).dated, R.PARAMS), "showid", "songid", "notebook_flag")


def profile(df: DataFrame, group: str, names: list[str]) -> DataFrame:
    """Per group and column, over all rows: how many values are missing, exact sums, extremes.

    The second sum weighs each value by its row's ids, so a value in the wrong row shows.
    """
    return digest.profile(df, group, F.col("showid") + 31 * F.col("songid"), {c: six_digits(c) for c in names})


def profile_sql(source: str, group: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT CAST({group} AS BIGINT) AS {group}, '{c}' AS feature, count(*) AS n,
  count(CASE WHEN v = -1 THEN 1 END) AS missing, CAST(sum(v) AS VARCHAR) AS total,
  CAST(sum(CAST(v * w AS DECIMAL(28, 6))) AS VARCHAR) AS weighted, CAST(min(v) AS DOUBLE) AS low,
  CAST(max(v) AS DOUBLE) AS high FROM (SELECT {group}, CAST(showid + 31 * songid AS DECIMAL(12, 0)) AS w,
  CAST({Q.six_digits(c)} AS DECIMAL(18, 6)) AS v FROM {source}) GROUP BY {group}"""
        for c in names
    )


_FEATURES = ["played", *P.feature_names()]


@query("panel_split", sql(profile_sql("split", "is_next", _FEATURES)))
def _(spark, sf):
    b = build(spark, sf)
    both = b.history.withColumn("is_next", F.lit(0)).unionByName(b.ahead.withColumn("is_next", F.lit(1)))
    return tidy(profile(both, "is_next", _FEATURES))


def analytical(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    b = build(spark, sf)
    return P.analytical_sets(b.history, b.ahead, b.occasions, R.coordinates(spark, sf), R.PARAMS)


_ANALYTICAL = [*_FEATURES, "new_tourid", *P.SHOW_FEATURES]


@query("analytical_set", sql(profile_sql("analytical", "is_next", _ANALYTICAL)))
def _(spark, sf):
    past, ahead = model_queries.stored_sets(spark, sf)
    both = past.withColumn("is_next", F.lit(0)).unionByName(ahead.withColumn("is_next", F.lit(1)))
    return tidy(profile(both, "is_next", _ANALYTICAL))


# The model's queries register themselves beside these.
from panelcast.plans import model_queries  # noqa: E402
