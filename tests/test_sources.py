import json
import os

import pytest
from pyspark.sql import functions as F

from panelcast.sources.tables import (
    explode_envelope,
    read_envelope,
    read_table,
    write_table,
)
from panelcast.sources.versions import Conflict, Published, publish_snapshot, refresh


def test_envelope_file_and_column(spark, tmp_path):
    payload = json.dumps({"data": [{"songid": 1, "song": "a", "artist": "x"}, {"songid": 2, "song": "b", "artist": None}]}, indent=1)
    (tmp_path / "songs.json").write_text(payload)
    df = read_envelope(spark, str(tmp_path / "songs.json"), "songs")
    assert sorted(map(tuple, df.collect())) == [(1, "a", "x"), (2, "b", None)]
    text = spark.createDataFrame([(7, payload)], "id int, p string")
    assert sorted(map(tuple, explode_envelope(text, "p", "songs").collect())) == [(7, 1, "a", "x"), (7, 2, "b", None)]


def test_csv_round_trip_and_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 0.5)], "songid long, showid long, y_pred_proba double")
    write_table(df, str(tmp_path / "s"), "csv")
    assert read_table(spark, str(tmp_path / "s"), "scores", "csv").collect() == df.collect()
    table = Published(spark, str(tmp_path / "t"))
    assert not publish_snapshot(df, table, refit=False) and not table.exists()
    assert publish_snapshot(df, table, refit=True) and table.read().collect() == df.collect()


def years(spark, *rows):
    return spark.createDataFrame(rows, "id long, showyear int, v string")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"), "showyear")
    table.replace_all(years(spark, (1, 2001, "a"), (2, 2002, "b"), (3, None, "c")))
    before = table.manifest()["parts"]
    table.replace_parts(years(spark, (4, 2002, "d"), (5, 2003, "e")))
    assert rows_of(table.read()) == [(1, 2001, "a"), (3, None, "c"), (4, 2002, "d"), (5, 2003, "e")]
    after = table.manifest()["parts"]
    assert {k for k in before if after[k] == before[k]} == {"_part=2001", "_part=__HIVE_DEFAULT_PARTITION__"}
    assert rows_of(table.read(1)) == [(1, 2001, "a"), (2, 2002, "b"), (3, None, "c")]
    # a table made from itself
    table.replace_all(table.read().withColumn("v", F.upper("v")))
    assert rows_of(table.read())[0] == (1, 2001, "A") and table.version == 3
    table.replace_all(table.read().where("false"))
    assert rows_of(table.read()) == [] and table.read().columns == ["id", "showyear", "v"]
    with pytest.raises(ValueError, match="columns differ"):
        table.replace_parts(years(spark, (1, 2001, "a")).drop("v"))


def test_a_writer_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = Published(spark, str(tmp_path / "t"), "showyear")
    table.replace_all(years(spark, (1, 2001, "a")))

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(table, "_commit", dies)  # all files are written, the manifest is not
        with pytest.raises(KeyboardInterrupt):
            table.replace_all(years(spark, (2, 2001, "b")))
    fails = F.udf(lambda v: 1 // 0, "string")
    with pytest.raises(Exception, match="division"):
        table.replace_all(years(spark, (3, 2001, "c")).withColumn("v", fails("v")))
    assert rows_of(Published(spark, str(tmp_path / "t")).read()) == [(1, 2001, "a")]
    assert len(os.listdir(tmp_path / "t" / "data")) >= 2


def test_two_writers_from_one_version_conflict(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    table.replace_all(years(spark, (1, 2001, "a")))
    table.replace_all(years(spark, (2, 2001, "b")), base=1)
    with pytest.raises(Conflict):
        table.replace_all(years(spark, (3, 2001, "c")), base=1)
    assert rows_of(table.read()) == [(2, 2001, "b")]


def test_refresh_processes_only_what_differs(spark, tmp_path):
    table, asked = Published(spark, str(tmp_path / "t"), "_bucket"), []

    def process(rows):
        asked.append(sorted(r.id for r in rows.collect()))
        return rows.withColumn("found", F.when(F.col("v") != "?", F.upper("v")))

    def run(*rows):
        counts = refresh(table, years(spark, *rows), "id", process, "found IS NOT NULL", buckets=8)
        return [counts[k] for k in ("new", "changed", "retried", "unchanged", "gone")]

    first = [(i, 2000, f"v{i}") for i in range(30)] + [(90, 2000, "?"), (None, 2000, "x"), (1, 2000, "z")]
    assert run(*first) == [31, 0, 0, 0, 0] and asked.pop() == [*range(30), 90]
    assert run(*first) == [0, 0, 1, 30, 0] and asked.pop() == [90] and table.version == 2
    assert [r.found for r in table.read().where("id = 1").collect()] == ["V1"]
    second = [r if r[0] != 5 else (5, 2000, "new") for r in first if r[0] != 90 and r[0] != 7] + [(50, 2001, "w")]
    held = table.manifest()["parts"]
    assert run(*second) == [1, 1, 0, 28, 2] and asked.pop() == [5, 50]
    assert any(table.manifest()["parts"].get(k) == v for k, v in held.items())
    # no news: nothing is written
    files = sum(len(f) for *_, f in os.walk(tmp_path))
    assert run(*second) == [0, 0, 0, 30, 0] and table.version == 3 and not asked
    assert files == sum(len(f) for *_, f in os.walk(tmp_path))
    whole = Published(spark, str(tmp_path / "whole"), "_bucket")
    refresh(whole, years(spark, *second), "id", process, "found IS NOT NULL", buckets=8)
    assert rows_of(table.read()) == rows_of(whole.read())
    assert run() == [0, 0, 0, 0, 30] and rows_of(table.read()) == []
