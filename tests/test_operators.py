from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from panelcast.functions import columns as C
from panelcast.operators import history as H
from panelcast.operators import lookup as L
from panelcast.operators import order as O
from panelcast.operators import panel as N
from panelcast.operators import periods as D
from panelcast.operators.trailing import trailing_window


def column(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_season_bounds(table):
    days = {(1, 5): "nye_run", (1, 6): "winter", (3, 21): "winter", (3, 22): "spring", (6, 20): "spring",
            (6, 21): "summer", (9, 22): "summer", (9, 23): "autumn", (12, 20): "autumn", (12, 21): "winter",
            (12, 26): "winter", (12, 27): "nye_run"}
    df = table([(date(2020, *d),) for d in days], "d date").select("d", C.season(F.col("d")).alias("s"))
    assert column(df, "d", "s") == {date(2020, *d): s for d, s in days.items()}


def test_lookup_key(table):
    rows = [(1, "Hall", "X", "S", "U"), (2, "Unknown", "X", None, "U"), (3, None, "X", "S", "U"),
            (4, "Hall", "X", None, "U"), (5, "Hall", "X", "S", None)]
    df = table(rows, "id int, v string, c string, s string, n string")
    key = C.lookup_key("v", "c", "s", "n", unknown={"v": "Unknown"}, optional=["s"])
    assert column(df.select("id", key.alias("k")), "id", "k") == {
        1: "Hall, X, S, U", 2: "X, U", 3: None, 4: "Hall, X, U", 5: None}


def test_cast_features(table):
    df = C.cast_features(table([(1, 2, "x")], "y int, a int, s string"), "y")
    assert df.dtypes == [("y", "bigint"), ("a", "double"), ("s", "string")]


def test_keep_first_takes_the_first_in_source_order(table):
    rows = [(1, 7, 2, 1), (1, 7, 1, 0), (1, 8, 3, 1)]  # same song twice, first one not flagged
    df = O.keep_first(table(rows, "show int, song int, pos int, jam int"), ["show", "song"], ["pos"])
    assert sorted(map(tuple, df.collect())) == [(1, 7, 1, 0), (1, 8, 3, 1)]


def test_runs_inherit_global_or_scope(table):
    d = date(2020, 1, 1)
    df = table([(1, "A", d), (2, "B", d + timedelta(1)), (3, "A", d + timedelta(2))], "id long, v string, d date")
    numbers = df.withColumn("place", F.ascii("v"))
    assert column(D.runs(numbers, "place", "d", "id"), "id", "runid") == {1: 0, 2: 1, 3: 1}
    assert column(D.runs(numbers, "place", "d", "id", inherit="scope"), "id", "runid") == {1: 0, 2: 1, 3: 0}


def test_run_shared_by_tour_and_no_tour_gives_one_row_each(table):
    d = date(2020, 1, 1)
    rows = [(1, 5, 0, d), (2, 61, 0, d + timedelta(1)), (3, None, 1, d + timedelta(9)), (4, 5, 2, d + timedelta(3))]
    df = D.unified_period(table(rows, "id long, tour long, run long, d date"), "tour", "run", "d", "id", 61)
    assert column(df, "id", "new_tourid") == {1: 0, 2: 1, 3: 2, 4: 0}


def test_closed_previous_period_is_over(table):
    d = date(2020, 1, 1)
    rows = [(0, d), (0, d + timedelta(10)), (1, d + timedelta(5)), (2, d + timedelta(7)), (3, d + timedelta(20))]
    df = D.closed_previous_period(table(rows, "p long, d date"), "p", "d", "prev")
    assert column(df, "p", "prev") == {0: None, 1: None, 2: 1, 3: 0}


def test_topk_flag_breaks_ties_by_id(table):
    df = table([(1, 1, 5), (1, 2, 5), (1, 3, 9), (2, 1, 0)], "show int, song int, n int")
    out = O.topk_flag(df, ["show"], ["song"], [F.desc("n"), F.asc("song")], 2, F.col("n") > 0, "flag")
    assert sorted(map(tuple, out.collect())) == [(1, 1, 5, 1), (1, 2, 5, 0), (1, 3, 9, 1), (2, 1, 0, 0)]


def test_same_day_is_past_for_carry_but_not_for_trailing(table):
    d = date(2020, 5, 1)
    df = table([(1, 1, d, 1), (1, 2, d, 0), (1, 3, d + timedelta(1), 0)], "song long, id long, d date, played long")
    flagged = df.withColumn("own", F.when(F.col("played") == 1, F.col("d")))
    assert column(H.carry_forward(flagged, "own", ["song"], "d", "id", "past"), "id", "past") == {1: None, 2: d, 3: d}
    out = trailing_window(df, "song", "d", {"n": ("sum", "played"), "rate": ("mean", "played")})
    assert column(out, "id", "n") == {1: 0, 2: 0, 3: 1}
    assert column(out, "id", "rate") == {1: None, 2: None, 3: 0.5}


@pytest.mark.parametrize("months,expected", [(12, 2), (24, 4)])
def test_trailing_leap_day(table, months, expected):
    days = [date(2018, 2, 28), date(2019, 2, 27), date(2019, 2, 28), date(2019, 3, 1), date(2020, 2, 29)]
    df = table([(1, d, 1) for d in days], "song long, d date, played long")
    out = trailing_window(df, "song", "d", {"n": ("sum", "played")}, 12, {2020: months} if months != 12 else None)
    # a year before Feb 29 is Feb 28, which counts
    assert column(out, "d", "n")[date(2020, 2, 29)] == expected


def test_asof_counts_the_day_itself(table):
    d = date(2020, 1, 10)
    plays = table([(1, 10, d), (1, 11, d - timedelta(1)), (2, 12, d)], "song long, id long, d date")
    albums = table([(1, 5, d), (1, 4, d - timedelta(5)), (2, 9, d + timedelta(1))], "song long, n int, r date")
    out = L.asof_join(plays, albums, ["song"], "d", "r", ["r", "n"], id_col="id")
    assert column(out, "id", "n") == {10: 5, 11: 4, 12: None}


def test_lookup_chain_and_incremental(table):
    todo = table([(1, "a", "x"), (2, "b", "x"), (3, "c", "z")], "id int, k1 string, k2 string")
    ref = table([("a", 1.0), ("x", 2.0)], "place string, lat double")
    out = L.lookup_chain(todo, ref, ["k1", "k2"], "place", ["lat"])
    assert column(out, "id", "lat") == {1: 1.0, 2: 2.0, 3: None}
    known = F.col("lat").isNotNull()
    fresh = L.unresolved(todo, out, "id", known)
    assert [r.id for r in fresh.collect()] == [3]
    assert L.incremental_merge(out, fresh, known).count() == 3


def test_panel_starts_on_the_debut_day(table):
    d = date(2020, 1, 1)
    shows = table([(i, d + timedelta(i // 2), i) for i in range(6)], "show long, d date, n long")
    firsts = table([(1, d), (2, d + timedelta(1))], "song long, debut date")
    for bits in (0, 1, 8):
        panel = N.build_panel(shows, firsts, "d", "debut", "n", block_bits=bits)
        assert sorted((r.song, r.show) for r in panel.collect()) == [(1, i) for i in range(6)] + [(2, i) for i in range(2, 6)]


def test_next_occasion(table):
    d = date(2020, 1, 1)
    known = table([(1, d, 0, 2020, 2019), (2, d, 1, 2020, 2019)], "id long, d date, n long, y long, py long")
    ahead = table([(3, d + timedelta(5), 2021), (4, d + timedelta(5), 2021), (5, d, 2020)], "id long, d date, y long")
    row = N.next_occasion(known, ahead, "d", ["id"], "n", {"y": "py"}).collect()
    assert [(r.id, r.n, r.py) for r in row] == [(3, 2, 2020)]
    assert N.next_occasion(known, ahead.where("id = 5"), "d", ["id"], "n", {"y": "py"}).count() == 0


def test_single_occurrence_falls_back_to_days_since(table):
    d = date(2020, 1, 1)
    rows = [(1, 1, d, 1, 1), (1, 2, d + timedelta(3), 0, None)]
    df = table(rows, "song long, id long, d date, played long, num_times_played_song long")
    df = df.withColumns({f"{s}_gap_song": F.lit(None).cast("double") for s in ("min", "max", "avg", "median")})
    out = N.panel_recency(df, {"": ()}, "song", "d", "id")
    last = out.where("id = 2").first()
    assert last.time_last_played_song == 3 and last.median_gap_song == 3.0 and last.num_times_played_song == 1
