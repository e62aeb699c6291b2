"""The current state of a changelog as a table: last value per key.

Micro-batches of a changelog are merged into a table of ``buckets`` key
buckets. A merge rewrites only the buckets its keys fall into, beside the old
ones, and then replaces the manifest that says which files are the table: a
reader, at any time, sees the table after some whole batch. The manifest names
the last batch of each writer, so a batch that is merged again after a restart
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetlens.session import checkpoint_path
from fleetlens.streaming.shared_files import Folder
from fleetlens.streaming.sinks import ensure_rocksdb_state

BUCKET = "_bucket"
MANIFEST = "manifest.json"


class LatestTable:
    """``order``: columns whose largest values make a row its key's last."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: list[str], buckets: int = 64) -> None:
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, order
        self.buckets = buckets
        self.files = Folder(spark, self.path)
        self.data = Folder(spark, f"{self.path}/data")

    def _manifest(self) -> dict:
        return self.files.get(MANIFEST, {"writers": {}, "buckets": {}, "before": {}, "schema": None})

    def _stored(self, manifest: dict, buckets: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.data.path}/{manifest['buckets'][b]}/{BUCKET}={b}" for b in buckets]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The table after the last whole batch."""
        manifest = self._manifest()
        if manifest["schema"] is None:
            raise FileNotFoundError(f"nothing has been merged into {self.path}")
        return self._stored(manifest, sorted(manifest["buckets"], key=int))

    def _last(self, rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*rows.columns), F.struct(*self.order)).alias("_row")
        return rows.groupBy(self.key).agg(last).select("_row.*")

    def merge(self, batch: DataFrame, batch_id: int, writer: str = "stream") -> bool:
        """Take a micro-batch; False where ``writer`` had merged it before."""
        manifest = self._manifest()
        if manifest["writers"].get(writer, -1) >= batch_id:
            return False
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        fresh = self._last(batch).persist()
        try:
            at = fresh.select(bucket.alias("b")).distinct().collect()  # at most ``buckets`` numbers
            touched = [str(r.b) for r in at]
            merged = fresh
            if manifest["schema"] is not None:
                had = [b for b in touched if b in manifest["buckets"]]
                merged = self._last(self._stored(manifest, had).unionByName(fresh))
            name = f"{writer}-{batch_id}"
            if touched:
                placed = merged.withColumn(BUCKET, bucket).repartition(max(1, len(touched)), BUCKET)
                placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.data.path}/{name}")
        finally:
            fresh.unpersist()
        now = {**manifest["buckets"], **{b: name for b in touched}}
        self.files.put(
            MANIFEST,
            {
                "writers": {**manifest["writers"], writer: batch_id},
                "buckets": now,
                "before": manifest["buckets"],
                "schema": batch.schema.jsonValue(),
            },
        )
        kept = {*now.values(), *manifest["buckets"].values()}  # a reader may still hold the table before
        for old in self.data.names():
            if old not in kept:
                self.data.delete(old)
        return True


def start(changelog: DataFrame, table: LatestTable, name: str, trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Keep ``table`` the latest state of a streamed changelog."""
    spark = changelog.sparkSession
    ensure_rocksdb_state(spark)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, batch_id, name)

    writer = changelog.writeStream.queryName(name).option("checkpointLocation", checkpoint or checkpoint_path(spark, name))
    return writer.foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start()
