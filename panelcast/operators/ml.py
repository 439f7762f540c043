"""Splits, fitted models, scores and the report, as Spark jobs.

A model is a Spark ``PipelineModel``: it holds the fitted preprocessing and the classifier, can be
saved and loaded, and adds ``PROBA``, the probability of class 1. See ``panelcast.models``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import feature_columns
from panelcast.models.base import FEATURES, PROBA
from panelcast.models.classifier import PanelClassifier, make_model, parse_params
from panelcast.models.neighbours import Neighbours
from panelcast.models.prepare import importance_select, standardise, variance_select
from panelcast.models.resample import oversample
from panelcast.operators.order import keep_first
from panelcast.params import ModelParams

__all__ = [
    "FEATURES", "PROBA", "assemble", "classifier", "fit", "fit_and_score", "importance_select", "knn_vote", "last_n_groups",
    "make_model", "oversample", "parse_params", "score", "score_report", "select_training", "standardise", "time_split",
    "training_rows", "variance_select", "vector_to_array",
]


# --- splits -----------------------------------------------------------------------------------

def time_split(df: DataFrame, group: str, start, cut=None) -> DataFrame:
    """Rows from group ``start`` on, and before ``cut`` if it is given."""
    rows = df.where(F.col(group) >= start)
    return rows if cut is None else rows.where(F.col(group) < cut)


def last_n_groups(df: DataFrame, group: str, n: int) -> DataFrame:
    """Rows of the ``n`` newest groups."""
    newest = df.select(group).distinct().orderBy(F.desc(group)).limit(n)
    return df.join(newest, group, "left_semi")


def select_training(df: DataFrame, params: ModelParams) -> DataFrame:
    """All rows for a refit, else those before the cut; of these only the newest groups if the
    validation slides."""
    rows = time_split(df, params.group, params.start, None if params.refit else params.cut)
    return last_n_groups(rows, params.group, params.last_groups) if params.cv_type == "sliding" else rows


# --- features ---------------------------------------------------------------------------------

def assemble(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` and one vector of ``cols``."""
    vector = VectorAssembler(inputCols=list(cols), outputCol=FEATURES)
    return vector.transform(df).select(*keep, FEATURES)


def knn_vote(
    train: DataFrame, test: DataFrame, cols: Sequence[str], label: str, train_ids: Sequence[str], ids: Sequence[str],
    k: int = 5, block_rows: int = 4096,
) -> DataFrame:
    """Mean label of the ``k`` nearest training rows of each test row (ties by ``train_ids``).

    Distances are between ``cols``; see ``Neighbours``.
    """
    x = F.array(*[F.col(c).cast("double") for c in cols])
    model = Neighbours(label, train_ids, k, block_rows).fit_on(train, x)
    return model.voted(test, x).select(*ids, PROBA)


# --- fit, score -------------------------------------------------------------------------------

def _features(df: DataFrame, params: ModelParams) -> list[str]:
    return feature_columns(df, [*params.ids, params.outcome, params.group])


def training_rows(train: DataFrame, params: ModelParams) -> DataFrame:
    """The rows to fit on: key, outcome as long, and features as doubles."""
    rows = select_training(train, params)
    cols = [F.col(c).cast("double").alias(c) for c in _features(train, params)]
    return rows.select(*params.key, F.col(params.outcome).cast("long").alias(params.outcome), *cols)


def classifier(train: DataFrame, params: ModelParams) -> PanelClassifier:
    """The unfitted pipeline for the features of ``train``."""
    return PanelClassifier.from_row(params.row, _features(train, params), params.outcome, params.key, params.seed)


def fit(train: DataFrame, params: ModelParams) -> PipelineModel:
    """The fitted pipeline; keep it with ``write().save``, take it back with ``PipelineModel.load``."""
    return classifier(train, params).fit(training_rows(train, params))


def score(model: PipelineModel, rows: DataFrame, params: ModelParams) -> DataFrame:
    """Probability of the outcome for each row from the first group on: songid, showid, y_pred_proba.

    Missing features of rows to score, such as coordinates, become -1.
    """
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in _features(rows, params)]
    ahead = time_split(rows, params.group, params.start).select(*params.key, *cols)
    return model.transform(ahead).select("songid", "showid", PROBA)


def fit_and_score(train: DataFrame, test: DataFrame, params: ModelParams) -> DataFrame:
    """Probability of the outcome for each row of ``test``: songid, showid, y_pred_proba."""
    return score(fit(train, params), test, params)


# --- report -----------------------------------------------------------------------------------

def score_report(
    scores: DataFrame, songs: DataFrame, shows: DataFrame, threshold: float = 0.5, top: int | None = None
) -> DataFrame:
    """Scores above the threshold with names, place and date, best first.

    ``top`` reports that many best ones instead.
    """
    named = scores.join(keep_first(songs.select("songid", "song"), ["songid"], ["song"]), "songid", "left")
    place = ["venue", "city", "state", "country", "showdate"]
    placed = named.join(keep_first(shows.select("showid", *place), ["showid"], place), "showid", "left")
    rows = placed.select(
        "showid", "songid", *place[:-1], F.date_format("showdate", "MM/dd/yyyy").alias("showdate"), "song",
        F.col(PROBA).alias("probability"),
    ).orderBy(F.desc("probability"), "showid", "songid")
    return rows.limit(top) if top is not None else rows.where(F.col("probability") > threshold)
