"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: str | int = "*", name: str = "panelcast", **settings) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master without one."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="panelcast-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, partition_by: tuple[str, ...] = (), group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    A stage that several later branches read is computed once, survives lost executors, and
    comes back with column pruning, filter pushdown and a known size. A task that reads or writes
    it holds a row group at a time, of up to 4,096 rows, and a writer looks at its size only every
    100 rows: where rows take megabytes, pass ``group_bytes``, at which a row group is closed.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    groups = {"parquet.block.size": group_bytes, "parquet.page.size.row.check.min": 1} if group_bytes else {}
    df.write.options(**groups).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
