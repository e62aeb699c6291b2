"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


# Sizing for large clusters (~100 TB inputs): scan splits of 256 MB, a high
# initial shuffle partition count that AQE coalesces to ~256 MB partitions,
# skewed shuffle partitions split at runtime. Broadcasts stay under Spark's
# measured-size threshold.
CLUSTER_PROFILE = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def build_session(
    master: str | None = None,
    app_name: str = "fleetlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    checkpoint_dir: str | None = None,
    profile: str = "local",
) -> SparkSession:
    """Session with the settings these jobs assume.

    AQE stays on so shuffle partition counts, join strategies and skewed
    partitions are re-planned from runtime statistics. The session time zone is
    pinned to UTC: event times are UTC instants.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if profile == "cluster":
        conf.update(CLUSTER_PROFILE)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if checkpoint_dir and not _configured_root(spark):
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``, which
    must be set (a shared file system path on a cluster)."""
    root = _configured_root(spark)
    if not root:
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; point it at a shared folder of the cluster"
        )
    return root.rstrip("/")


def _configured_root(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir`` (static conf) or a directory set on the
    context with ``setCheckpointDir``."""
    try:
        root = spark.conf.get(CHECKPOINT_CONF, None)
    except Exception:  # noqa: BLE001 - conf not readable on some session kinds
        root = None
    if root:
        return root
    try:  # classic sessions: a directory set with setCheckpointDir
        sc = spark.sparkContext
        return sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
        return None


def checkpoint_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), name)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """``name`` below the shared checkpoint folder, made now and removed when
    the driver's JVM ends. Only a local master without the setting (tests) gets
    a folder of its own; elsewhere the missing setting is an error."""
    if not _configured_root(spark) and _one_machine(spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    path = f"{checkpoint_root(spark)}/{name}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def _one_machine(master: str) -> bool:
    return master.startswith("local") and not master.startswith("local-cluster")


def cut_lineage(df, name: str = "stage"):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    return a DataFrame reading it back.

    Ends a long chain of shuffles: a lost executor then replays from the table,
    not from the source, and the re-read has real size statistics. Starts a
    job at once; raises where ``spark.checkpoint.dir`` is unset. The folder is
    removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tables/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
