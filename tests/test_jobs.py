"""The jobs from landed files to the report."""

import json
import random
from datetime import date, timedelta

import pytest

from panelcast.jobs import batch
from panelcast.params import ModelParams, PanelParams

ROW = {"model": "rf", "params": json.dumps({
    "rf__n_estimators": 12, "rf__max_depth": 5, "rf__min_samples_split": 30, "scaler": "standard", "fs": "variance", "sampler": "random"})}


def landed(folder):
    """Songs 0-7 alternate by show parity, so the next show's songs can be told."""
    rng = random.Random(5)
    shows, sets, day = [], [], date(2019, 1, 5)
    for i in range(150):
        day += timedelta(days=rng.choice([1, 2, 9, 20]))
        venue = i % 6
        shows.append({"showid": 1000 + i, "showdate": str(day), "showyear": day.year, "showmonth": day.month, "showday": day.day,
                      "artistid": 1, "exclude_from_stats": int(i == 9), "venueid": venue, "tourid": 61 if i % 11 == 0 else i // 12,
                      "venue": f"Hall {venue}", "city": f"C{venue}", "state": None if venue == 3 else f"S{venue % 2}", "country": "USA"})
        if i < 149:
            for song in range(8):
                if rng.random() < (0.9 if song % 2 == i % 2 else 0.15):
                    sets.append({"showid": 1000 + i, "uniqueid": len(sets), "songid": song, "is_original": int(song < 6), "isjamchart": int(rng.random() < 0.3)})
    songs = [{"songid": s, "song": f"Song {s}", "artist": "Phish" if s < 6 else "Mike Gordon"} for s in range(8)]
    for name, rows in (("shows", shows), ("setlists", sets), ("songs", songs)):
        (folder / name).mkdir(parents=True)
        for k in range(2):
            (folder / name / f"{k}.json").write_text(json.dumps({"data": rows[k::2]}))
    csv = {
        "albums": ["songid,albumid,releasedate", *[f"{s},{s},2019-0{s + 1}-10" for s in range(5)]],
        "venues": ["venueid,venuename,city,state,country", *[f"{v},Hall {v},C{v},{'' if v == 3 else f'S{v % 2}'},USA" for v in range(6)]],
        "gazetteer": ["place,latitude,longitude", *[f'"Hall {v}, C{v}, S{v % 2}, USA",{v}.5,{-v}.25' for v in (0, 1, 2)],
                      '"C3, USA",33.0,44.0', '"C4, S0, USA",1.0,2.0'],
    }
    for name, lines in csv.items():
        (folder / name).mkdir()
        (folder / name / "part.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def at(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    landed(folder / "raw")
    spark.createDataFrame([ROW]).write.option("header", True).option("escape", '"').csv(str(folder / "raw" / "model_params"))
    return batch.Folders(str(folder / "raw"), str(folder / "out"), {n: "envelope" for n in ("shows", "setlists", "songs")})


def test_from_files_to_the_report(spark, at):
    params = ModelParams(start=2019)
    assert batch.refresh_venues(spark, at)["new"] == 6
    assert batch.refresh_venues(spark, at) == {"new": 0, "changed": 0, "retried": 1, "unchanged": 5, "gone": 0}  # venue 5 is unknown
    batch.prepare(spark, at, PanelParams())
    past, ahead = (at.published(spark, n).read() for n in ("history", "ahead"))
    assert len(past.columns) == len(ahead.columns) == 122 and ahead.count() == 8
    assert past.where("latitude IS NULL").count() == 0 and set(at.published(spark, "history").manifest()["parts"]) >= {"_part=2019", "_part=2020"}
    assert at.published(spark, "training").read().count() == past.count()
    batch.predict(spark, at, params)
    rows = batch.report(spark, at, threshold=0.5).collect()
    # show 1149 is an odd one
    assert {r.songid for r in rows} == {1, 3, 5, 7} and [r.probability for r in rows] == sorted([r.probability for r in rows], reverse=True)
    assert {(r.showid, r.song, r.venue) for r in rows} == {(1149, f"Song {s}", "Hall 5") for s in (1, 3, 5, 7)}
    first = sorted(map(tuple, at.published(spark, "scores").read().collect()))
    # the kept model scores again without being fitted
    batch.predict(spark, at, params, refit=False)
    assert sorted(map(tuple, at.published(spark, "scores").read().collect())) == first
    assert at.published(spark, "models").version == 1 and at.published(spark, "scores").version == 2
    assert len(batch.report(spark, at, top=6).collect()) == 6


def test_no_refit_keeps_the_snapshot(spark, at):
    before = at.published(spark, "training").version
    batch.prepare(spark, at, PanelParams(), refit=False)
    assert at.published(spark, "training").version == before and at.published(spark, "history").version == 2
