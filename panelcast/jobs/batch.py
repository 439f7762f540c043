"""From landed files to the report, each job reading what the one before has published."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.columns import lookup_key, replace_where
from panelcast.operators import ml as M
from panelcast.operators.lookup import lookup_chain
from panelcast.params import ModelParams, PanelParams
from panelcast.plans.panel_plan import PanelBuild, analytical_sets
from panelcast.sources.tables import read_envelope, read_table, write_table
from panelcast.sources.versions import Published, publish_snapshot, refresh

COORDINATES = ("latitude", "longitude")


@dataclass(frozen=True)
class Folders:
    """Where things lie: ``raw`` has the landed tables, ``out`` what the jobs publish.

    ``formats`` says how a raw table was landed: "envelope" (JSON payloads), "csv" or "parquet".
    """

    raw: str
    out: str
    formats: Mapping[str, str] = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        kind = self.formats.get(name, "csv")
        if kind == "envelope":
            return read_envelope(spark, f"{self.raw}/{name}", name)
        return read_table(spark, f"{self.raw}/{name}", name, kind)

    def published(self, spark: SparkSession, name: str, partition: str | None = None) -> Published:
        return Published(spark, f"{self.out}/{name}", partition)


def located_venues(venues: DataFrame, gazetteer: DataFrame, renamed: Mapping[str, Mapping[str, str]], unknown: str = "Unknown") -> DataFrame:
    """Venues with both lookup keys and the coordinates of the first that the gazetteer knows."""
    clean = venues
    for column, values in renamed.items():
        clean = replace_where(clean, column, dict(values))
    keyed = clean.withColumns({
        "lookup_id": lookup_key("venuename", "city", "state", "country", unknown={"venuename": unknown}, optional=["state"]),
        "lookup_id2": lookup_key("city", "state", "country", optional=["state"]),
    })
    return lookup_chain(keyed, gazetteer, ["lookup_id", "lookup_id2"], "place", COORDINATES)


def refresh_venues(spark: SparkSession, at: Folders, renamed: Mapping[str, Mapping[str, str]] | None = None) -> dict[str, int]:
    """Locate new and changed venues, and those not found before; the others stay as published."""
    gazetteer = at.table(spark, "gazetteer")
    table = at.published(spark, "venues", "_bucket")
    return refresh(
        table, at.table(spark, "venues"), "venueid", lambda rows: located_venues(rows, gazetteer, renamed or {}), "latitude IS NOT NULL"
    )


def prepare(spark: SparkSession, at: Folders, params: PanelParams, refit: bool = True) -> None:
    """Raw tables to the analytical sets: history by year, the next occasion, and the training snapshot."""
    raw = {n: at.table(spark, n) for n in ("shows", "setlists", "songs", "albums")}
    build = PanelBuild(raw["shows"], raw["setlists"], raw["songs"], raw["albums"], params)
    places = at.published(spark, "venues", "_bucket").read().select("venueid", *COORDINATES)
    past, ahead = analytical_sets(build.history, build.ahead, build.occasions, places, params)
    at.published(spark, "history", "showyear").replace_all(past)
    at.published(spark, "ahead").replace_all(ahead)
    publish_snapshot(at.published(spark, "history", "showyear").read(), at.published(spark, "training"), refit)


def predict(spark: SparkSession, at: Folders, params: ModelParams, refit: bool = True) -> None:
    """Scores of the next occasion, by a model fitted from the raw parameter row or the kept one.

    A fitted model is saved first; what is published then is its folder.
    """
    kept = at.published(spark, "models")
    if refit or not kept.exists():
        row = at.table(spark, "model_params").first()
        params = params.with_row(row.asDict())
        model = M.fit(at.published(spark, "training").read(), params)
        folder = f"{at.out}/models/saved/{kept.version + 1}"
        model.write().overwrite().save(folder)
        kept.replace_all(spark.createDataFrame([(folder, row["model"], row["params"])], "folder string, model string, params string"))
    model = PipelineModel.load(kept.read().first()["folder"])
    ahead = at.published(spark, "ahead").read()
    at.published(spark, "scores").replace_all(M.score(model, ahead, params))


def report(spark: SparkSession, at: Folders, threshold: float = 0.5, top: int | None = None) -> DataFrame:
    """The scores above the threshold with names and places, best first, also as one CSV file."""
    rows = M.score_report(at.published(spark, "scores").read(), at.table(spark, "songs"), at.table(spark, "shows"), threshold, top)
    write_table(rows.coalesce(1), f"{at.out}/report", "csv")
    return read_table(spark, f"{at.out}/report", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), "csv").orderBy(
        F.desc("probability"), "showid", "songid"
    )
