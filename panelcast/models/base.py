"""What the models share: column names, and tables of numbers saved beside the parameters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLWritable,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES, PROBA = "features", "y_pred_proba"


class TableWriter(DefaultParamsWriter):
    """Parameters as JSON, the model's numbers as Parquet."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.table(self.sparkSession).write.parquet(f"{path}/data")


class TableReader(DefaultParamsReader):
    def load(self, path: str):
        instance = super().load(path)
        instance.restore(self.sparkSession.read.parquet(f"{path}/data"))
        return instance


class TableModel(Model, MLReadable, MLWritable):
    """A model whose numbers are a table: ``table`` gives it, ``restore`` takes it back."""

    def table(self, spark) -> DataFrame:
        raise NotImplementedError

    def restore(self, table: DataFrame) -> None:
        raise NotImplementedError

    def write(self) -> TableWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> TableReader:
        return TableReader(cls)


class ClassOne(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The probability of class 1 as a plain column, without the classifier's other columns."""

    def _transform(self, df: DataFrame) -> DataFrame:
        extra = ("rawPrediction", "probability", "prediction", "__flags")
        return df.select(*[c for c in df.columns if c not in extra], vector_to_array("probability")[1].alias(PROBA))


class WithoutFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Without the feature vector."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(FEATURES)


def vector() -> Column:
    """The feature vector as an array of doubles."""
    return vector_to_array(FEATURES)


def matrix(column: pa.Array, dims: int | None = None) -> np.ndarray:
    """A list column as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1 if dims is None and len(column) else dims or 0)


def labelled(df: DataFrame, label: str) -> DataFrame:
    """(y, x): labels as long and vectors as arrays, without rows that have no label."""
    return df.select(F.col(label).cast("long").alias("y"), vector().alias("x")).where("y IS NOT NULL")
