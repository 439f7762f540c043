"""Tables published in versions: a reader sees one whole version, a writer that fails changes nothing."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.operators.order import keep_first


class Conflict(RuntimeError):
    """Another writer has published a version meanwhile."""


class Published:
    """A folder of Parquet files and numbered manifests.

    A write puts new files into a folder of their own and then renames one manifest into place; that
    rename is the commit, and it fails if another writer took the number. A manifest names, for each
    value of ``partition`` (one part without it), the folder that holds its rows. So single
    partitions can be replaced, and files of the version that is being read are never touched: a
    table can be rewritten from itself. Folders of writers that died are not read by anyone.
    """

    def __init__(self, spark: SparkSession, path: str, partition: str | None = None):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    @property
    def version(self) -> int:
        """The number of the newest version, 0 before the first."""
        found = [n for n in self._names(f"{self.path}/manifests") if n.endswith(".json") and not n.startswith((".", "_"))]
        return max((int(n.removesuffix(".json")) for n in found), default=0)

    def manifest(self, version: int | None = None) -> dict:
        number = self.version if version is None else version
        if not number:
            return {"schema": None, "parts": {}}
        lines = self.spark.read.text(f"{self.path}/manifests/{number:09d}.json", wholetext=True)
        return json.loads(lines.first()[0])

    def exists(self) -> bool:
        return self.version > 0

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of an older one."""
        held = self.manifest(version)
        if held["schema"] is None:
            raise ValueError(f"nothing has been published in {self.path}")
        schema = StructType.fromJson(held["schema"])
        folders = sorted(held["parts"].values())
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _stored(self, df: DataFrame) -> dict[str, str]:
        """Write the rows of ``df``; gives each part's folder."""
        folder = f"data/{uuid.uuid4().hex}"
        if self.partition is None:
            df.write.parquet(f"{self.path}/{folder}")
            return {"all": folder}
        df.withColumn("_part", F.col(self.partition)).write.partitionBy("_part").parquet(f"{self.path}/{folder}")
        return {n: f"{folder}/{n}" for n in self._names(f"{self.path}/{folder}") if n.startswith("_part=")}

    def _commit(self, base: int, schema: StructType, parts: dict[str, str]) -> int:
        number = base + 1
        text = json.dumps({"schema": schema.jsonValue(), "parts": parts})
        self._fs.mkdirs(self._path(f"{self.path}/manifests"))
        draft = self._path(f"{self.path}/manifests/_{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        final = self._path(f"{self.path}/manifests/{number:09d}.json")
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise Conflict(f"version {number} of {self.path} has been published by another writer")
        return number

    def replace_all(self, df: DataFrame, base: int | None = None) -> int:
        """Publish ``df`` as the whole table. ``base``: the version that it was made from."""
        base = self.version if base is None else base
        return self._commit(base, df.schema, self._stored(df))

    def replace_parts(self, df: DataFrame, gone: Sequence[str] = (), base: int | None = None) -> int:
        """Publish ``df`` in place of the partitions that it has rows of; the others stay as they are.

        ``gone``: values of partitions that end without rows.
        """
        if self.partition is None:
            raise ValueError("the table has no partitions")
        base = self.version if base is None else base
        held = self.manifest(base)
        if held["schema"] is not None and StructType.fromJson(held["schema"]) != df.schema:
            raise ValueError("the columns differ from those of the partitions that stay")
        stay = {k: v for k, v in held["parts"].items() if k not in {f"_part={g}" for g in gone}}
        return self._commit(base, df.schema, {**stay, **self._stored(df)})


def publish_snapshot(df: DataFrame, table: Published, refit: bool) -> bool:
    """Publish the training snapshot only when the model is to be refitted."""
    if refit:
        table.replace_all(df)
    return refit


BUCKET, HASH = "_bucket", "_hash"


def refresh(
    table: Published, source: DataFrame, key: str, process, resolved: str, buckets: int = 64, order: Sequence[str] | None = None,
) -> dict[str, int]:
    """Bring ``table`` up to date with ``source``, processing only what needs it.

    ``process`` maps source rows to result rows, one per ``key``; ``resolved`` is a condition on a
    result row that needs no second try. A row of the source is told by a digest of its columns:
    new, changed, or unchanged; unchanged ones that are resolved stay as they are, the others are
    processed again, and keys that the source no longer has go. Only the buckets of keys in which
    something differs are written, in one new version made from the old one. Without news nothing is
    written. Of rows that repeat a key the first by ``order`` (all columns) counts; rows without key
    are left out. Returns how many keys were new, changed, retried, unchanged and gone.
    """
    columns = source.columns
    rows = keep_first(source.where(F.col(key).isNotNull()), [key], list(order or [c for c in columns if c != key]))
    told = rows.withColumns({HASH: F.sha2(F.to_json(F.struct(*columns)), 256), BUCKET: F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")})
    base = table.version
    old = table.read(base) if base else None
    if old is None:
        state = told.select(key, BUCKET, F.lit("new").alias("_state"))
    else:
        before = old.select(F.col(key).alias("_key"), F.col(HASH).alias("_before"), F.expr(resolved).alias("_resolved"), F.col(BUCKET).alias("_old_bucket"))
        both = told.join(before, F.col(key) == F.col("_key"), "full")
        is_new, is_gone = F.col("_key").isNull(), F.col(key).isNull()
        kind = F.when(is_new, "new").when(is_gone, "gone").when(F.col(HASH) != F.col("_before"), "changed")
        kind = kind.when(F.coalesce("_resolved", F.lit(False)), "unchanged").otherwise("retried")
        state = both.select(F.coalesce(key, "_key").alias(key), F.coalesce(BUCKET, "_old_bucket").alias(BUCKET), kind.alias("_state"))
    counts = {r["_state"]: r["count"] for r in state.groupBy("_state").count().collect()}
    out = {k: counts.get(k, 0) for k in ("new", "changed", "retried", "unchanged", "gone")}
    if old is not None and not (out["new"] or out["changed"] or out["retried"] or out["gone"]):
        return out
    todo = told.join(state.where("_state IN ('new', 'changed', 'retried')").select(key), key, "left_semi")
    fresh = process(todo.select(*columns)).join(todo.select(F.col(key).alias("_key"), HASH, BUCKET), F.col(key) == F.col("_key")).drop("_key")
    if old is None:
        table.replace_parts(fresh, base=base)
        return out
    touched = state.where("_state <> 'unchanged'").select(BUCKET).distinct()
    kept = old.join(touched, BUCKET, "left_semi").join(state.where("_state = 'unchanged'").select(key), key, "left_semi")
    merged = kept.select(*old.columns).unionByName(fresh.select(*[F.col(f.name).cast(f.dataType) for f in old.schema]))
    filled = {r[0] for r in touched.collect()}  # bucket numbers
    left = {r[0] for r in merged.select(BUCKET).distinct().collect()}
    table.replace_parts(merged, gone=[str(b) for b in filled - left], base=base)
    return out
