"""What panel rows know of the past, cut into short stretches, against a plain loop."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from panelcast.operators import panel as N
from panelcast.operators.scan import STATS

STAT = [f"{s}_gap_song" for s in STATS]


def rows_of(seed):
    dice, out = random.Random(seed), []
    for i in range(120):
        day, hall = date(2020, 1, 1) + timedelta(days=dice.randrange(60)), dice.choice(["a", "b", "c", None])
        for song in (1, 2, None):
            hit = int(dice.random() < 0.3)
            out.append((song, i, day, hall, hit, *[float(dice.randrange(9)) if hit else None for _ in range(2)], 100 + i))
    return out


def looked_up(rows, key):
    """id and song -> day, count and gap of the newest played row before it in its key."""
    newest, out = {}, {}
    for song, i, day, hall, hit, count, gap, number in sorted(rows, key=lambda r: (r[2], r[1])):
        k = key(song, hall)
        before = newest.get(k) if None not in k else None
        out[i, song] = (None,) * 4 if before is None else ((day - before[0]).days, *before[1:])
        if hit:
            newest[k] = day, count, gap, number
    return out


@pytest.mark.parametrize("chunk_rows", [1, 9, 65_536])
def test_recency_is_the_same_however_days_are_cut(spark, table, chunk_rows):
    rows = rows_of(chunk_rows)
    df = table(rows, "song long, id long, d date, hall string, played int, n double, g double, number long")
    for suffix in ("", "_hall"):
        df = df.withColumn(f"num_times_played_song{suffix}", F.col("n").cast("long"))
        df = df.withColumns({f"{s}{suffix}": F.col("g") for s in STAT})
    out = N.panel_recency(
        df.drop("n", "g"), {"": (), "_hall": ("hall",)}, "song", "d", "id", extra={"played": {"number": "last_number"}}, chunk_rows=chunk_rows
    ).collect()
    wanted = {"": looked_up(rows, lambda s, h: (s,)), "_hall": looked_up(rows, lambda s, h: (s, h))}
    assert len(out) == len(rows)
    for r in out:
        for suffix, found in wanted.items():
            days, count, gap, number = found[r["id"], r["song"]]
            got = r[f"time_last_played_song{suffix}"], r[f"num_times_played_song{suffix}"], r[f"median_gap_song{suffix}"]
            assert got == (days, None if count is None else int(count), gap)
            if not suffix:
                assert r["last_number"] == number


def test_all_scopes_share_one_shuffle_of_the_rows(spark, table):
    df = table([(1, 1, date(2020, 1, 1), 1, 1, 1.0)], "song long, id long, d date, hall int, played int, g double")
    for suffix in ("", "_hall", "_other"):
        df = df.withColumn(f"num_times_played_song{suffix}", F.lit(1)).withColumns({f"{s}{suffix}": F.col("g") for s in STAT})
    plan = N.panel_recency(df, {"": (), "_hall": ("hall",), "_other": ("g",)}, "song", "d", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and "__own" not in plan
