"""Columns that are called as the operators' own ones are."""

import pytest
from pyspark.sql import functions as F

from panelcast.llm import decontam, langid, mixing, preference, secret_scan, simhash

NAMES = ["_doc", "_hash", "_n", "_secrets", "_a", "_b", "_p", "doc", "hash", "n", "row", "held", "held_id", "held_hash", "clean", "kept", "a", "b", "p", "k", "g", "s", "x.y", "Value"]
KEY = "q7Zt3xLm9Pw2Rb6K"
ITEM = "which ancient river crossed seven silent valleys before reaching the copper harbour where merchants weighed amber"


@pytest.fixture(scope="module")
def docs(spark):
    texts = [ITEM, "plain words of a clean text", "plain words of a clean text", f'so password = "{KEY}" it goes', None, ""]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(1, texts[1], "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").select("*", *[F.lit(f"keep {n}").alias(n) for n in NAMES])


def untouched(out, docs):
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[n] == f"keep {n}" for r in rows for n in NAMES)
    return sorted((r["doc_id"], str(r["text"])) for r in rows)


def test_one_of_each(docs):
    got = untouched(simhash.one_of_each(docs, simhash.near_duplicates(docs)), docs)
    assert [i for i, _ in got] == [0, 1, 3, 4]  # null and empty texts share fingerprint zero


def test_without_leaks(spark, docs):
    bench = spark.createDataFrame([(1, ITEM, "h")], "item_id long, text string, hash string")
    got = untouched(decontam.without_leaks(docs, decontam.leaks(docs, bench)), docs)
    assert [i for i, _ in got] == [1, 1, 2, 3, 4, 5]


def test_redacted(docs):
    got = untouched(secret_scan.redacted(docs, secret_scan.scan(docs)), docs)
    assert len(got) == 7 and dict(got)[3] == 'so password = "[SECRET]" it goes'


def test_mixed(docs):
    assert mixing.mixed(docs, carry=("text",)).count() == 7


def test_language(docs):
    assert langid.identify(docs, langid.fit(docs.withColumn("lang", F.lit("en"))), rows=True).select("row.*").columns == docs.columns


def test_preferences(spark):
    turns = "array<struct<role:string,text:string>>"
    pairs = spark.createDataFrame([([("user", "q"), ("assistant", "x")], [("user", "q"), ("assistant", "y")])], f"chosen {turns}, rejected {turns}")
    wide = pairs.select("*", *[F.lit(f"keep {n}").alias(n) for n in [*NAMES, "prompt"]])
    bare, got = preference.preferences(pairs).first(), preference.preferences(wide).first()
    assert all(got[n] == f"keep {n}" for n in NAMES)
    assert got.asDict().items() >= bare.asDict().items() and bare["prompt_turns"] == 1
