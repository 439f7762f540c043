"""A training corpus from documents: language, near duplicates, leaks, secrets, mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import decontam, langid, mixing, secret_scan, simhash
from panelcast.runtime import cut_lineage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in no known language (null, empty, no letters) or an ambiguous one.

    The classifiers learn from the rows that have a ``lang``.
    """
    return langid.accepted(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest doc_id."""
    return simhash.one_of_each(docs, simhash.near_duplicates(docs, shingle=4, max_bits=4))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold an item of the benchmark."""
    return decontam.without_leaks(docs, decontam.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secret_scan.redacted(docs, secret_scan.scan(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with how often the mix takes each: ``repeats`` times, 0 if it leaves it out."""
    return mixing.mixed(docs, mixing.Mix(), carry=("text", "lang"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mix", mix),
]

# Learned models and searches in a latent space have no SQL form; the tests hold the stages against
# plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on ``documents``; each is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *stored, (_, last) = STAGES
    for _, stage in stored:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
