"""Streaming sinks: keyed JSON records, files, memory (tests), foreachBatch.

Every query gets its own checkpoint folder under the shared
``spark.checkpoint.dir`` (independent readers keep independent progress), so
a restarted or re-attempted query resumes exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.session import checkpoint_path
from fleetlens.sources.codec import ISO_INSTANT, ISO_LOCAL


def keyed_records(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``(key, value)`` with the record's ``fields`` as JSON: the shape a keyed
    topic sink takes (Kafka ``key``/``value`` columns). Source metadata beside
    the record (offset, partition, event id) is not published."""
    value = F.to_json(
        F.struct(*fields),
        {"timestampFormat": ISO_INSTANT, "timestampNTZFormat": ISO_LOCAL},
    )
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_rocksdb_state(spark) -> None:
    """The keyed processors (``transformWithStateInPandas``) need the RocksDB
    state store; it also keeps large state off the executor heap. Set before
    a query starts (the provider of an existing checkpoint cannot change)."""
    if spark.conf.get(STATE_STORE_CONF, None) != ROCKSDB_PROVIDER:
        spark.conf.set(STATE_STORE_CONF, ROCKSDB_PROVIDER)


def _trigger(writer, trigger: dict | None):
    trigger = trigger or {"availableNow": True}
    return writer.trigger(**trigger)


def start(
    df: DataFrame,
    name: str,
    fmt: str = "json",
    path: str | None = None,
    output_mode: str = "append",
    trigger: dict | None = None,
    options: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Start a streaming query writing to ``fmt`` (json, parquet, memory,
    kafka, ...) with its checkpoint under the shared checkpoint folder."""
    spark = df.sparkSession
    ensure_rocksdb_state(spark)
    writer = (
        df.writeStream.queryName(name)
        .format(fmt)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint_path(spark, name))
    )
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = _trigger(writer, trigger)
    return writer.start(path) if path else writer.start()


def start_keyed(df: DataFrame, key: str, fields: list[str], name: str, **kw) -> StreamingQuery:
    """Keyed record sink (S6): JSON values of ``fields`` keyed by ``key``."""
    return start(keyed_records(df, key, fields), name, **kw)


def start_branches(
    df: DataFrame,
    branch_col: str,
    paths: dict[str, str],
    name: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Route each micro-batch's rows to one output per branch label.

    The batch is tagged once and persisted for the per-branch writes. Each
    slice is written to ``<path>/batch_id=<id>`` with overwrite, so a retried
    batch replaces its own output instead of duplicating it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for label, out in paths.items():
                (
                    batch.filter(F.col(branch_col) == label)
                    .drop(branch_col)
                    .write.mode("overwrite")
                    .json(f"{out.rstrip('/')}/batch_id={batch_id}")
                )
        finally:
            batch.unpersist()

    spark = df.sparkSession
    ensure_rocksdb_state(spark)
    writer = (
        df.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint_path(spark, name))
        .foreachBatch(write)
    )
    return _trigger(writer, trigger).start()


def start_outputs(
    df: DataFrame,
    outputs: dict[str, Callable[[DataFrame], DataFrame]],
    root: str,
    name: str,
    trigger: dict | None = None,
    fmt: str = "parquet",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Several outputs of one flow: each micro-batch is computed once (and kept
    for that where there is more than one output), and each output's rows go to
    ``root/<output>/batch_id=<id>``, overwritten when the batch is tried again.
    ``outputs`` maps a name to the output's rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if len(outputs) > 1:
            batch = batch.persist()
        try:
            for output, rows in outputs.items():
                path = f"{root.rstrip('/')}/{output}/batch_id={batch_id}"
                rows(batch).write.mode("overwrite").format(fmt).save(path)
        finally:
            if len(outputs) > 1:
                batch.unpersist()

    spark = df.sparkSession
    ensure_rocksdb_state(spark)
    writer = (
        df.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint or checkpoint_path(spark, name))
        .foreachBatch(write)
    )
    return _trigger(writer, trigger).start()


def write_keyed(df: DataFrame, key: str, fields: list[str], path: str, fmt: str = "json", options: dict | None = None) -> None:
    """Batch publish of keyed records (pings keyed by route, fares by
    vehicle): one ``(key, value)`` row per record. ``fmt="kafka"`` with a
    ``topic`` option writes to a topic when the connector is present."""
    writer = keyed_records(df, key, fields).write.mode("append").format(fmt)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if fmt == "kafka":
        writer.save()
    else:
        writer.save(path)
