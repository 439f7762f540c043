"""Scans with fixed schemas, landed JSON envelopes, and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "shows": "showid long, showdate date, showyear int, showmonth int, showday int, artistid int, "
    "exclude_from_stats int, venueid long, tourid long, venue string, city string, state string, "
    "country string",
    "setlists": "showid long, uniqueid long, songid long, is_original int, isjamchart int",
    "songs": "songid long, song string, artist string",
    "albums": "songid long, albumid long, releasedate date",
    "venues": "venueid long, venuename string, city string, state string, country string",
    "gazetteer": "place string, latitude double, longitude double",
    "model_params": "model string, params string",
    "scores": "songid long, showid long, y_pred_proba double",
}


def read_table(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Scan files; ``schema`` is a DDL string, or the name of one of ``SCHEMAS``."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # quotes inside quotes are doubled, as other CSV writers do
        reader = reader.option("header", True).option("enforceSchema", False).option("escape", '"')
    if schema:
        reader = reader.schema(SCHEMAS.get(schema, schema))
    return reader.load(path)


def read_envelope(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed API payloads: files that each hold one object ``{"data": [row, ...]}``."""
    row = SCHEMAS.get(schema, schema)
    payload = spark.read.schema(f"data array<struct<{_fields(row)}>>").option("multiLine", True).json(path)
    return payload.select(F.inline("data"))


def explode_envelope(df: DataFrame, column: str, schema: str) -> DataFrame:
    """The same payload held in a string column; other columns stay."""
    row = SCHEMAS.get(schema, schema)
    parsed = F.from_json(column, f"data array<struct<{_fields(row)}>>")["data"]
    return df.select(*[c for c in df.columns if c != column], F.inline(parsed))


def _fields(ddl: str) -> str:
    return ", ".join("{}: {}".format(*field.strip().split(" ", 1)) for field in ddl.split(","))


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()
) -> None:
    """Overwrite ``path``; CSV gets a header."""
    writer = df.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
