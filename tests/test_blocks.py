"""The panel by blocks of occasions, and histories that need no cutting."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from panelcast.operators import history as H
from panelcast.operators import panel as N
from panelcast.operators import scan as S
from panelcast.plans import panel_plan as P

DAY = date(2000, 1, 1)


def _rows(spark):
    """30 shows on 15 days, some songs at each, one show and one song without id."""
    shows = [(i, DAY + timedelta(days=i // 2), i, i % 4) for i in range(30)]
    plays = [(i, s, d, n, 10 * i + s) for i, d, n, _ in shows for s in range(3) if (i * 7 + s * 5) % 4 == 0]
    plays += [(None, 1, DAY, None, -1), (4, None, DAY + timedelta(days=2), 4, -2)]
    return (
        spark.createDataFrame(shows, "show long, d date, n long, k long"),
        spark.createDataFrame(plays, "show long, song long, d date, n long, v long"),
    )


def test_panel_attaches_own_rows_as_a_join_does(spark):
    shows, plays = _rows(spark)
    firsts = N.debuts(plays.where("show IS NOT NULL"), "song", "d", "debut")
    plain = N.build_panel(shows, firsts, "d", "debut", "n")
    want = plain.join(plays.select("show", "song", "v"), ["show", "song"], "left").select("show", "song", "d", "v")
    for bits in (1, 8):
        got = N.build_panel(shows, firsts, "d", "debut", "n", bits, own=plays, ids=("show", "song"))
        assert sorted(got.select(*want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_panel_carries_the_newest_value_over_blocks(spark):
    shows, plays = _rows(spark)
    firsts = N.debuts(plays.where("show IS NOT NULL"), "song", "d", "debut")
    plain = N.build_panel(shows, firsts, "d", "debut", "n").join(plays.select("show", "song", "v"), ["show", "song"], "left")
    want = H.carry_forward(plain, "v", ["song"], "d", "show", "past").select("show", "song", F.col("past").alias("v"))
    assert want.where("v IS NOT NULL").count() > 20
    for bits in (1, 2, 8):
        got = N.build_panel(shows, firsts, "d", "debut", "n", bits, own=plays, ids=("show", "song"), carry=("v",))
        assert sorted(got.select(*want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_short_histories_are_not_cut(spark):
    shows, _ = _rows(spark)
    shows = shows.unionByName(spark.createDataFrame([(90, None, 0, 1), (91, DAY, 0, None)], shows.schema))
    assert S.fitting_grains(shows, {"k": ("k",)}, "d", id_col="show") == {"k": "all"}
    assert S.fitting_grains(shows, {"k": ("k",)}, "d", limit=3, id_col="show")["k"] != "all"
    nameless = shows.unionByName(spark.createDataFrame([(None, DAY, 0, 1)], shows.schema))
    assert S.fitting_grains(nameless, {"k": ("k",)}, "d", id_col="show") == {"k": "day"}
    values = {"i": S.running_index(), "before": S.lag("n"), "next": S.lead("n"), "last": S.last_before("n")}
    cut, whole = (S.scan(shows, (S.by_day(["k"], "d", "show", grain=g), values)) for g in ("day", "all"))
    dated = F.col("d").isNotNull()
    assert sorted(whole.where(dated).collect(), key=str) == sorted(cut.where(dated).collect(), key=str)
    assert [r["i"] for r in whole.where(~dated).collect()] == [r["i"] for r in cut.where(~dated).collect()] == [None]
    assert "Join" not in whole._jdf.queryExecution().toString()


def test_next_occasion_takes_repeated_known_rows(spark):
    known = spark.createDataFrame(
        [(1, 1, DAY, 0, 5, 4), (2, 1, DAY, 1, 6, 5), (2, 1, DAY, 1, 6, 5), (1, 2, DAY, 9, 9, 9)],
        "show long, venue long, d date, n long, period long, before long",
    )
    ahead = spark.createDataFrame([(7, 3, DAY + timedelta(days=3), 6)], "show long, venue long, d date, period long")
    found = N.next_occasion(known, ahead, "d", ["show", "venue"], "n", {"period": "before"}).collect()
    assert [(r["show"], r["n"], r["before"]) for r in found] == [(7, 2, 5)]


def test_rates_and_flags_need_no_stored_stats(spark, monkeypatch):
    plays = spark.createDataFrame(
        [(i, s, DAY + timedelta(days=200 * i), 2000 + i, 1, 1, 1, "x", i, 1999 + i, 0, int(i == 1)) for i in range(5) for s in range(3) if (i + s) % 3],
        "showid long, songid long, showdate date, showyear int, venueid long, new_tourid long, runid long, state string, "
        "show_nm long, prev_year int, prev_tourid long, isjamchart int",
    )
    built = P.PanelBuild(None, None, None, None)
    built.__dict__.update(plays=plays, occasions=plays.drop("songid").distinct())
    keys = {(r["showid"], r["songid"]) for r in plays.collect()}
    got = built.outcomes.collect()
    assert {(r["showid"], r["songid"]) for r in got if r["played"] == 1} == keys and len(got) > len(keys)
    flags = P.activity(plays, built.panel_shows).collect()
    assert len(flags) == len(got) and any(r["jammed_in_last_year"] for r in flags)
    assert not {"frame", "play_stats", "recent"} & built.__dict__.keys()
