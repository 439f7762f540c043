"""From raw tables to the feature panel and the analytical set."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import (
    SEASON_CODES,
    calendar_features,
    fill_sentinel,
    is_cover,
    map_codes,
    map_values,
)
from panelcast.operators.history import expanding_by_scope, play_gaps, scope_history
from panelcast.operators.lookup import asof_join, min_support
from panelcast.operators.order import keep_first, ordinal, previous_period, topk_flag
from panelcast.operators.panel import build_panel, debuts, next_occasion, panel_recency
from panelcast.operators.periods import (
    expanding_over_periods,
    gap_stats,
    period_position,
    runs,
    spine_fill,
    unified_period,
)
from panelcast.operators.scan import STATS, fitting_grains
from panelcast.operators.trailing import trailing_by_day
from panelcast.params import PanelParams
from panelcast.runtime import cut_lineage

ROW = "__row"
PLAY = "__play"

# Name suffix of each scope, and the columns it groups by besides the song.
SCOPES = {
    "": (),
    "_venue": ("venueid",),
    "_run": ("runid",),
    "_tour": ("new_tourid",),
    "_state": ("state",),
}
# Scopes of the previous-tour statistics.
TOUR_SCOPES = {"": (), "_state": ("state",), "_venue": ("venueid",)}

OCCASION_KEYS = (
    "showid", "showdate", "new_tourid", "state", "venueid", "runid", "prev_year", "prev_tourid",
    "show_nm",
)
SHOW_FEATURES = (
    "showyear", "showmonth", "showday", "num_show_venue", "time_since_last_venue",
    "current_run_venue", "num_show_state", "time_since_last_state", "time_since_last_show",
    "show_number", "days_left_on_tour", "season", "tour_season", "days_on_tour",
    "tour_show_number", "day_of_week", "time_since_formation",
)


def _stat_names(pattern: str) -> dict[str, str]:
    return {stat: pattern.format(stat) for stat in STATS}


def _tour_names(kind: str, scope: str) -> tuple[str, dict[str, str]]:
    return f"{kind}{scope}_last_tour", _stat_names("{}_" + f"{kind}{scope}_tour")


# Gap stats of the previous period; one name is irregular and kept.
YEAR_PLAYS = _stat_names("{}_show_gap_last_year_sng")
TOUR_PLAYS = _stat_names("{}_show_gap_last_tour_sng")
YEAR_JAMS = _stat_names("{}_show_gap_last_year_jam")
TOUR_JAMS = _stat_names("{}_show_gap_last_tour_jam") | {"median": "median_show_gap_tour_year_jam"}

# The trailing-year aggregates over panel rows.
TRAILING = {
    "rate_played_this_year": ("mean", "played"),
    "rate_jammed_this_year": ("mean", "isjamchart"),
    "tot_times_played_in_last_year": ("sum", "played"),
    "tot_times_jammed_in_last_year": ("sum", "isjamchart"),
    "avg_gap_year": ("mean", "CASE WHEN played = 1 THEN show_gap END"),
    "avg_jam_gap_year": ("mean", "CASE WHEN isjamchart = 1 THEN show_jam_gap END"),
}


def eligible(shows: DataFrame, params: PanelParams) -> DataFrame:
    """Occasions of the artist that count, with the country where the state is missing."""
    return shows.where(
        (F.col("artistid") == params.artistid) & (F.col("exclude_from_stats") == 0)
    ).withColumn("state", F.coalesce("state", "country"))


def occasion_features(shows: DataFrame, params: PanelParams) -> DataFrame:
    """One row per eligible occasion: history in its venue and state, run, period, calendar."""
    counted = cut_lineage(eligible(shows, params).drop("artistid", "exclude_from_stats", "venue", "city", "country"))
    scopes = {"venue": "venueid", "state": "state"}
    grains = fitting_grains(counted, {s: (c,) for s, c in scopes.items()}, "showdate", id_col="showid")
    history = cut_lineage(scope_history(counted, scopes, "showdate", "showid", grains))
    in_runs = cut_lineage(
        runs(history, "venueid", "showdate", "showid", params.max_run_gap, params.inherit, grain=grains["venue"])
    )
    grains = fitting_grains(in_runs, {c: (c,) for c in ("runid", "tourid")}, "showdate", id_col="showid")
    periods = cut_lineage(
        unified_period(in_runs, "tourid", "runid", "showdate", "showid", params.no_tour)
    )
    placed = period_position(periods, "new_tourid", "tourid", "runid", "showdate", "showid", grains=grains)
    out = calendar_features(placed, "showdate", params.epoch).withColumn(
        "tour_season", map_codes(F.col("tour_season"), SEASON_CODES)
    )
    gaps = ["time_since_last_venue", "time_since_last_state", "time_since_last_show"]
    return fill_sentinel(out, -1, [*gaps, "days_left_on_tour"]).select(
        "showid", "showdate", "venueid", "tourid", "new_tourid", "runid", "state", *SHOW_FEATURES
    )


def occurrences(
    occasions: DataFrame, setlists: DataFrame, songs: DataFrame, albums: DataFrame,
    params: PanelParams,
) -> DataFrame:
    """One row per (occasion, song) played, with occasion numbers and previous periods."""
    shows = occasions.select(
        "showid", "showdate", "venueid", "new_tourid", "runid", "state", "showyear"
    )
    rows = shows.join(setlists, "showid")
    played = cut_lineage(keep_first(rows, ["showid", "songid"], params.source_order))
    with_sets = cut_lineage(played.select("showid", "showdate", "showyear", "new_tourid").distinct())
    numbers = ordinal(with_sets, "showdate", "showid", name="show_nm").drop("showdate")
    years = previous_period(with_sets, "showyear", "prev_year", params.previous_year)
    tours = previous_period(with_sets, "new_tourid", "prev_tourid")
    on_album = albums.select("songid").distinct().withColumn("__album", F.lit(True))
    family = (
        songs.where(map_values(F.col("artist"), params.aliases) == params.family)
        .select("songid").distinct().withColumn("__family", F.lit(True))
    )
    cover = is_cover(
        F.col("is_original"), F.col("__album").isNotNull(), F.col("__family").isNotNull()
    )
    return (
        played.join(numbers, "showid", "left")
        .join(years, "showyear", "left")
        .join(tours, "new_tourid", "left")
        .join(on_album, "songid", "left")
        .join(family, "songid", "left")
        .select(
            "showid", "songid", "showdate", "showyear", "venueid", "new_tourid", "runid", "state",
            "show_nm", "prev_year", "prev_tourid", "isjamchart", cover.alias("is_cover"),
        )
    )


def scope_grains(occasions: DataFrame) -> dict[str, str]:
    """How finely each scope's histories have to be cut: a song has one row per occasion, so the
    occasions of a scope bound its chunks."""
    return fitting_grains(occasions, SCOPES, "showdate")


def scope_gaps(plays: DataFrame, scope: str, grains: dict[str, str] | None = None) -> DataFrame:
    """Occurrences with their count and gap in one scope, overall also the gap in occasions.

    ``plays`` has its rows' numbers in ``PLAY``. Only what the scope needs is dealt out by its keys.
    """
    cols = SCOPES[scope]
    own = plays.select(PLAY, "showid", "songid", "showdate", *(cols or ("show_nm", "showyear", "new_tourid")))
    return play_gaps(
        own, {scope: cols}, "songid", "showdate", "showid", number=None if cols else "show_nm", grains=grains
    )


def scope_stats(gaps: DataFrame, scope: str, shows: bool = True) -> DataFrame:
    """``scope_gaps``, a stored table, with expanding stats of the gaps, overall also in occasions
    (``shows``)."""
    values = {"gap_song": {scope: SCOPES[scope]}}
    if shows and not SCOPES[scope]:
        values["show_gap_song"] = {"": ()}
    return expanding_by_scope(gaps, "songid", "showdate", "showid", values)


def show_gap_stats(gaps: DataFrame) -> DataFrame:
    """The overall ``scope_gaps``, a stored table, with expanding stats of the gap in occasions."""
    own = gaps.select("showid", "songid", "showdate", "show_nm", "num_times_played_song", "show_gap_song")
    return expanding_by_scope(own, "songid", "showdate", "showid", {"show_gap_song": {"": ()}})


def play_features(plays: DataFrame, stats: Mapping[str, DataFrame]) -> DataFrame:
    """Occurrences with their counts, gaps and expanding gap stats of all scopes.

    ``stats`` has the ``scope_stats`` of each; they meet the occurrences by number.
    """
    out = plays
    for found in stats.values():
        own = [c for c in found.columns if c not in {*OCCASION_KEYS, "songid", "showyear"}]
        out = out.join(found.select(*own), PLAY, "left")
    return out.drop(PLAY)


def jam_gaps(plays: DataFrame) -> DataFrame:
    """Flagged occurrences with their count and gaps among each other."""
    own = plays.where("isjamchart = 1").select(
        "showid", "songid", "showdate", "showyear", "new_tourid", "show_nm", "isjamchart"
    )
    return play_gaps(
        own, {"": ()}, "songid", "showdate", "showid",
        number="show_nm", count="num_times_jammed_song", gap="gap_j_song",
        number_gap="show_gap_j_song",
    )


def jam_features(gaps: DataFrame) -> DataFrame:
    """``jam_gaps``, a stored table, with expanding stats in occasions."""
    return expanding_by_scope(
        gaps, "songid", "showdate", "showid", {"show_gap_j_song": {"": ()}},
        count="num_times_jammed_song",
    )


def covers(plays: DataFrame) -> DataFrame:
    """The cover flag of each song, as of its first occurrence."""
    return keep_first(
        plays.select("songid", "is_cover", "showdate", "showid"), ["songid"], ["showdate", "showid"]
    ).select("songid", "is_cover")


def panel_occasions(plays: DataFrame, occasions: DataFrame) -> DataFrame:
    """Occasions with a setlist and the next one, flagged ``is_next``."""
    known = plays.select(*OCCASION_KEYS, "showyear").distinct()
    ahead = next_occasion(
        plays.select(*OCCASION_KEYS, "showyear"),
        occasions.select("showid", "showdate", "new_tourid", "state", "venueid", "runid", "showyear"),
        "showdate", ["showid", "venueid"], "show_nm",
        {"showyear": "prev_year", "new_tourid": "prev_tourid"},
    )
    return known.withColumn("is_next", F.lit(0)).unionByName(ahead.withColumn("is_next", F.lit(1)))


def panel_shows(plays: DataFrame, occasions: DataFrame) -> DataFrame:
    """The panel's occasions; a stored table."""
    return cut_lineage(panel_occasions(plays, occasions).drop("showyear"))


def panel_frame(plays: DataFrame, shows: DataFrame, own: DataFrame | None = None, carry: tuple = ()) -> DataFrame:
    """Occasions x songs since each song's first day, the next occasion included.

    ``own`` (showid, songid, showdate, show_nm, values) and ``carry``: see ``build_panel``.
    """
    return build_panel(
        shows, debuts(plays, "songid", "showdate", "song_debut_date"),
        "showdate", "song_debut_date", "show_nm", own=own, ids=("showid", "songid"), carry=carry,
    )


def outcomes(plays: DataFrame, shows: DataFrame) -> DataFrame:
    """The panel with its outcome only, for what needs no stats; not stored, as it is one join."""
    own = plays.select("showid", "songid", "showdate", "show_nm", F.lit(1).alias("played"))
    return fill_sentinel(panel_frame(plays, shows, own), 0, ["played"])


def in_last_year(year: str) -> Column:
    """1 where the newest occurrence, in ``year``, fell into the previous year or later."""
    return F.when(F.col(year) >= F.col("prev_year"), 1).otherwise(0)


def activity(plays: DataFrame, shows: DataFrame) -> DataFrame:
    """The panel with the flags of ``recency_features`` alone: played and jammed in the last year."""
    year = F.struct("showyear")
    own = plays.select(
        "showid", "songid", "showdate", "show_nm", year.alias("__played"),
        F.when(F.col("isjamchart") == 1, year).alias("__jammed"),
    )
    past = panel_frame(plays, shows, own, ("__played", "__jammed"))
    years = past.withColumns({"__year": F.col("__played.showyear"), "__jam_year": F.col("__jammed.showyear")})
    return years.withColumns(
        {"played_in_last_year": in_last_year("__year"), "jammed_in_last_year": in_last_year("__jam_year")}
    ).drop("__played", "__jammed", "__year", "__jam_year")


def overall_gaps(plays: DataFrame, shows: DataFrame) -> DataFrame:
    """The panel with outcome, flag and the gaps of ``recency_features`` since the last (flagged)
    occurrence, for what needs no stats; a stored table."""
    number = F.struct("show_nm")
    own = plays.select(
        "showid", "songid", "showdate", "show_nm", F.lit(1).alias("played"),
        F.when(F.col("isjamchart") == 1, 1).alias("isjamchart"), number.alias("__played"),
        F.when(F.col("isjamchart") == 1, number).alias("__jammed"),
    )
    past = panel_frame(plays, shows, own, ("__played", "__jammed"))
    gaps = {"show_gap": F.col("show_nm") - F.col("__played.show_nm"), "show_jam_gap": F.col("show_nm") - F.col("__jammed.show_nm")}
    filled = fill_sentinel(past.withColumns(gaps), 0, ["played", "isjamchart"])
    return cut_lineage(filled.select("showid", "songid", "showdate", "played", "isjamchart", *gaps))


def flagged_recency(plays: DataFrame, shows: DataFrame, show_stats: DataFrame, jam_stats: DataFrame) -> DataFrame:
    """The panel with the gaps of ``recency_features`` in occasions and what it knows of flagged
    occurrences, from ``show_gap_stats`` and ``jam_features``."""
    by_play, by_jam = ([f"{stat}_{gap}" for stat in STATS] for gap in ("show_gap_song", "show_gap_j_song"))
    own = show_stats.select("showid", "songid", "showdate", "show_nm", F.struct("show_nm", *by_play).alias("__played"))
    jammed = jam_stats.select(
        "showid", "songid", "isjamchart", F.struct("show_nm", "num_times_jammed_song", *by_jam).alias("__jammed")
    )
    past = panel_frame(plays, shows, own.join(jammed, ["showid", "songid"], "left"), ("__played", "__jammed"))
    gap = F.col("show_nm") - F.col("__played.show_nm")
    return fill_sentinel(past, 0, ["isjamchart"]).select(
        "showid", "songid", "isjamchart", gap.alias("show_gap"), (F.col("show_nm") - F.col("__jammed.show_nm")).alias("show_jam_gap"),
        F.coalesce("__jammed.num_times_jammed_song", F.lit(0)).alias("n_times_jammed_song"),
        *[F.coalesce(F.col(f"__played.{c}"), gap).cast("double").alias(c) for c in by_play],
        *[F.coalesce(F.col(f"__jammed.{c}"), gap).cast("double").alias(c) for c in by_jam],
    )


def played_rate(panel: DataFrame, params: PanelParams) -> DataFrame:
    """The panel's rows with their song's rate of the trailing year."""
    rate = {"rate_played_this_year": TRAILING["rate_played_this_year"]}
    past = trailing_by_day(panel, "songid", "showdate", rate, params.trailing_months, params.trailing_overrides)
    return panel.join(past, ["songid", "showdate"], "left")


def own_values(plays: DataFrame, jams: DataFrame) -> DataFrame:
    """What the panel's rows get of their own occurrence: outcome, and the values as of it."""
    own = plays.select(
        "showid", "songid", "showdate", "show_nm", F.lit(1).alias("played"), F.col("showyear").alias("lst_played_yr"),
        F.col("show_nm").alias("lst_played_shownum"),
        *[f"num_times_played_song{s}" for s in SCOPES],
        *[f"{stat}_gap_song{s}" for s in SCOPES for stat in STATS],
        *[f"{stat}_show_gap_song" for stat in STATS],
    )
    jammed = jams.select(
        "showid", "songid", "isjamchart", F.col("showyear").alias("lst_jamed_yr"),
        F.col("show_nm").alias("lst_jamed_shownum"), "num_times_jammed_song",
        *[f"{stat}_show_gap_j_song" for stat in STATS],
    )
    return own.join(jammed, ["showid", "songid"], "left")


def attach_plays(plays: DataFrame, shows: DataFrame, play_stats: DataFrame, jam_stats: DataFrame) -> DataFrame:
    """The panel with outcome and the values as of each occurrence, null where the song was not played."""
    panel = panel_frame(plays, shows, own_values(play_stats, jam_stats))
    return fill_sentinel(panel, 0, ["played", "isjamchart"])


def recency_features(frame: DataFrame) -> DataFrame:
    """Everything known strictly before each row: the five scopes, occasion gaps, jams."""
    shows = {f"{stat}_show_gap_song": f"{stat}_show_gap_song" for stat in STATS}
    jams = {f"{stat}_show_gap_j_song": f"{stat}_show_gap_j_song" for stat in STATS}
    out = panel_recency(
        frame, SCOPES, "songid", "showdate", "showid",
        extra={
            "played": {"lst_played_shownum": "__show", "lst_played_yr": "__year", **shows},
            "isjamchart": {
                "lst_jamed_shownum": "__jam_show", "lst_jamed_yr": "__jam_year",
                "num_times_jammed_song": "n_times_jammed_song", **jams,
            },
        },
    )
    gap = F.col("show_nm") - F.col("__show")
    return out.withColumns(
        {
            "show_gap": gap,
            "show_jam_gap": F.col("show_nm") - F.col("__jam_show"),
            "played_in_last_year": in_last_year("__year"),
            "jammed_in_last_year": in_last_year("__jam_year"),
            "n_times_jammed_song": F.coalesce("n_times_jammed_song", F.lit(0)),
            "time_since_song_debut": F.datediff("showdate", "song_debut_date"),
            # missing jam gaps take the gap since the last occurrence, flagged or not
            **{c: F.coalesce(F.col(c), gap).cast("double") for c in [*shows, *jams]},
        }
    ).drop("__show", "__year", "__jam_show", "__jam_year")


def previous_tour_counts(frame: DataFrame, plays: DataFrame, cols: tuple, scope: str) -> DataFrame:
    """Plays in the previous tour (0 if none), and their expanding stats over tours."""
    value, names = _tour_names("num_times_song_played", scope)
    counts = plays.groupBy(F.col("new_tourid").alias("prev_tourid"), "songid", *cols).agg(
        F.count(F.lit(1)).alias(value)
    )
    spine = spine_fill(frame, ["prev_tourid", "songid", *cols], counts, value)
    return expanding_over_periods(spine, value, "prev_tourid", ["songid", *cols], names)


def previous_tour_rates(frame: DataFrame, cols: tuple, scope: str) -> DataFrame:
    """Share of the previous tour's occasions with the song, and its expanding stats."""
    value, names = _tour_names("rate_song_played", scope)
    rates = frame.groupBy(F.col("new_tourid").alias("prev_tourid"), "songid", *cols).agg(
        F.avg("played").alias(value)
    )
    return expanding_over_periods(rates, value, "prev_tourid", ["songid", *cols], names)


def period_lookups(frame: DataFrame, plays: DataFrame, jams: DataFrame) -> dict[tuple, DataFrame]:
    """All statistics of the previous period, as one table per join key."""
    tables = {}
    for scope, cols in TOUR_SCOPES.items():
        key = ("prev_tourid", "songid", *cols)
        table = previous_tour_counts(frame, plays, cols, scope).join(
            previous_tour_rates(frame, cols, scope), list(key), "left"
        )
        tables[key] = table
    for period, prev, played, jammed in (
        ("showyear", "prev_year", YEAR_PLAYS, YEAR_JAMS),
        ("new_tourid", "prev_tourid", TOUR_PLAYS, TOUR_JAMS),
    ):
        key = (prev, "songid")
        own = gap_stats(plays, ["songid", period], "show_gap_song", played)
        flagged = gap_stats(jams, ["songid", period], "show_gap_j_song", jammed)
        both = own.join(flagged, ["songid", period], "left").withColumnRenamed(period, prev)
        tables[key] = tables[key].join(both, list(key), "left") if key in tables else both
    return tables


def album_numbers(albums: DataFrame) -> DataFrame:
    """Release rows with the 0-based number of their album, by (releasedate, albumid)."""
    first = keep_first(
        albums.select("albumid", "releasedate"), ["albumid"], ["releasedate"]
    )
    numbers = ordinal(first, "releasedate", "albumid", name="album_num", block_bits=None)
    return albums.join(numbers.drop("releasedate"), "albumid", "left")


def notebook_flag(frame: DataFrame, params: PanelParams) -> DataFrame:
    """Marks, per occasion, the songs most played in the trailing year but not in the last shows."""
    return topk_flag(
        frame, ["showid"], ["songid"],
        [F.col("tot_times_played_in_last_year").desc(), F.col("songid").asc()],
        params.notebook_size,
        (F.col("tot_times_played_in_last_year") > 0) & (F.col("show_gap") > params.notebook_gap),
        "notebook_flag",
    )


def row_lookups(dated: DataFrame, tables: dict[tuple, DataFrame], params: PanelParams) -> DataFrame:
    """Per row after its song's first day: the notebook flag and all of ``tables``.

    Only the rows' keys are dealt out for these joins, the table with the longest key first, so that
    rows stay narrow; the panel's own columns meet the result once.
    """
    keys = list(dict.fromkeys(c for key in tables for c in key))
    asked = ["tot_times_played_in_last_year", "show_gap", "time_since_song_debut"]
    out = notebook_flag(dated.select(ROW, "showid", *keys, *asked), params).where("time_since_song_debut > 0").drop("showid", *asked)
    for key, table in sorted(tables.items(), key=lambda kt: -len(kt[0])):
        out = out.join(table, list(key), "left")
    return out.drop(*keys)


def day_features(recent: DataFrame, plays: DataFrame, albums: DataFrame, params: PanelParams) -> DataFrame:
    """What depends on song and day only: the trailing year, the newest album, the cover flag."""
    trailing = trailing_by_day(
        recent, "songid", "showdate", TRAILING, params.trailing_months, params.trailing_overrides
    )
    released = asof_join(
        recent.select("songid", "showdate").distinct(), album_numbers(albums), ["songid"],
        "showdate", "releasedate", ["releasedate", "album_num"],
    ).drop("releasedate")
    return trailing.join(released, ["songid", "showdate"], "left").join(
        covers(plays), "songid", "left"
    )


def feature_names() -> list[str]:
    """The 99 features of the panel."""
    names = [f"time_last_played_song{s}" for s in SCOPES]
    names += [f"{stat}_gap_song{s}" for s in SCOPES for stat in STATS]
    names += [f"num_times_played_song{s}" for s in SCOPES]
    for kind in ("num_times_song_played", "rate_song_played"):
        for scope in TOUR_SCOPES:
            value, stats = _tour_names(kind, scope)
            names += [value, *stats.values()]
    names += ["time_since_song_debut", "album_num", "is_cover", "show_gap", "played_in_last_year"]
    names += [f"{stat}_show_gap_song" for stat in STATS]
    names += [*TOUR_PLAYS.values(), *YEAR_PLAYS.values()]
    names += ["show_jam_gap", "jammed_in_last_year", "n_times_jammed_song"]
    names += [f"{stat}_show_gap_j_song" for stat in STATS]
    names += [*YEAR_JAMS.values(), *TOUR_JAMS.values()]
    return [*names, *TRAILING, "notebook_flag"]


def split_panel(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """History and next occasion, with -1 for what is missing."""
    filled = fill_sentinel(features, -1)
    return (
        filled.where("is_next = 0").drop("is_next"),
        filled.where("is_next = 1").drop("is_next"),
    )


def analytical_sets(
    history: DataFrame, ahead: DataFrame, occasions: DataFrame, places: DataFrame,
    params: PanelParams,
) -> tuple[DataFrame, DataFrame]:
    """Panel rows with occasion features and coordinates, of songs played often enough.

    History rows without coordinates are dropped; next-occasion rows are all kept.
    """
    show = occasions.select("showid", "new_tourid", "venueid", *SHOW_FEATURES)
    where = keep_first(places, ["venueid"], ["latitude", "longitude"])
    # stored, so that its size is known before the panel would be shuffled to meet it
    located = cut_lineage(show.join(where, "venueid", "left").drop("venueid"))
    full = history.join(located, "showid", "left").where(F.col("latitude").isNotNull())
    full_next = ahead.join(located, "showid", "left")
    return (
        min_support(full, full, "songid", "played", params.min_support),
        min_support(full_next, full, "songid", "played", params.min_support),
    )


class PanelBuild:
    """The stages of one preparation run, each stored when it is first asked for."""

    def __init__(
        self, shows: DataFrame, setlists: DataFrame, songs: DataFrame, albums: DataFrame,
        params: PanelParams | None = None,
    ):
        self.shows, self.setlists, self.songs, self.albums = shows, setlists, songs, albums
        self.params = params or PanelParams()
        self._scope_gaps: dict[str, DataFrame] = {}

    @cached_property
    def occasions(self) -> DataFrame:
        return cut_lineage(occasion_features(self.shows, self.params))

    @cached_property
    def grains(self) -> dict[str, str]:
        return scope_grains(self.occasions)

    @cached_property
    def plays(self) -> DataFrame:
        """``PLAY`` numbers the rows."""
        plays = occurrences(self.occasions, self.setlists, self.songs, self.albums, self.params)
        return cut_lineage(plays.withColumn(PLAY, F.monotonically_increasing_id()))

    def scope_gaps(self, scope: str) -> DataFrame:
        """Of one scope alone, stored when it is first asked for."""
        if scope not in self._scope_gaps:
            self._scope_gaps[scope] = cut_lineage(scope_gaps(self.plays, scope, self.grains))
        return self._scope_gaps[scope]

    @cached_property
    def play_stats(self) -> DataFrame:
        return cut_lineage(play_features(self.plays, {s: scope_stats(self.scope_gaps(s), s) for s in SCOPES}))

    @cached_property
    def jam_gaps(self) -> DataFrame:
        return cut_lineage(jam_gaps(self.plays))

    @cached_property
    def jam_stats(self) -> DataFrame:
        return cut_lineage(jam_features(self.jam_gaps))

    @cached_property
    def panel_shows(self) -> DataFrame:
        return panel_shows(self.plays, self.occasions)

    @cached_property
    def outcomes(self) -> DataFrame:
        return outcomes(self.plays, self.panel_shows)

    @cached_property
    def frame(self) -> DataFrame:
        return cut_lineage(attach_plays(self.plays, self.panel_shows, self.play_stats, self.jam_stats))

    @cached_property
    def recent(self) -> DataFrame:
        """``__row`` numbers the panel's rows, so that what is found for them joins on one column."""
        return cut_lineage(recency_features(self.frame).withColumn(ROW, F.monotonically_increasing_id()))

    @cached_property
    def by_day(self) -> DataFrame:
        return cut_lineage(day_features(self.recent, self.plays, self.albums, self.params))

    @cached_property
    def dated(self) -> DataFrame:
        """Not stored: one row per song and day is joined, the panel's rows stay where they are."""
        return self.recent.join(self.by_day, ["songid", "showdate"], "left")

    @cached_property
    def features(self) -> DataFrame:
        """The panel with all 99 features, history and next occasion together."""
        tables = period_lookups(self.frame, self.play_stats, self.jam_stats)
        found = row_lookups(self.dated, tables, self.params)
        out = self.dated.where("time_since_song_debut > 0").join(found, ROW)
        return cut_lineage(out.select("showid", "songid", "is_next", "played", *feature_names()))

    @property
    def history(self) -> DataFrame:
        return split_panel(self.features)[0]

    @property
    def ahead(self) -> DataFrame:
        return split_panel(self.features)[1]
