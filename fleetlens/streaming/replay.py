"""Stored records replayed as a stream.

``arrival_files`` writes records as numbered files of a landing folder, in
arrival order and with rising modification times, which is the order in which
the file source takes them; ``run`` drives a streaming query over everything
there (``availableNow``) and waits. Checkpoints, files and outputs stand below
the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.session import scratch_folder

ROWS_PER_FILE = 500_000
LEAST_FILES = 4
STATE_PARTITIONS = 8
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared root, removed when the driver's JVM ends."""
    return scratch_folder(spark, f"replay/{name}-{uuid.uuid4().hex}")


def arrival_files(df: DataFrame, order: list[str], rows_per_file: int = ROWS_PER_FILE, least_files: int = LEAST_FILES) -> str:
    """Write ``df`` as JSON files whose order is that of ``order``; returns the
    folder. One range-sorted write, then one time stamp a file, so that a
    file, which is one micro-batch, holds about ``rows_per_file`` records
    (fewer where there would not be ``least_files`` of them)."""
    spark = df.sparkSession
    folder = new_folder(spark, "landing")
    files = max(least_files, -(-df.count() // rows_per_file))
    ranges = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ranges.write.mode("append").option("timestampFormat", MICROS).json(folder)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    if parts:
        newest = fs.getFileStatus(parts[-1]).getModificationTime()
        for i, part in enumerate(parts):  # part numbers are ranges, so names sort by arrival
            fs.setTimes(part, newest - 1000 * (len(parts) - i), -1)
    return folder


def record_stream(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """The files of :func:`arrival_files` as a stream, one a micro-batch."""
    reader = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", "1")
    return reader.option("timestampFormat", MICROS).json(folder)


def run(start: Callable[[], StreamingQuery], spark: SparkSession, state_partitions: int | None = None) -> StreamingQuery:
    """Start a query over what is there, wait for its end, raise its error.
    The number of state stores (``STATE_PARTITIONS`` if not given) is fixed by
    the first micro-batch, so it is set around the start only."""
    conf = "spark.sql.shuffle.partitions"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(state_partitions or STATE_PARTITIONS))
    try:
        query = start()
    finally:
        spark.conf.set(conf, before)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def utc(df: DataFrame, *names: str) -> DataFrame:
    """Zone-less times as instants (event time of a stream must be one)."""
    cols = {n: F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{n}`)")) for n in names}
    return df.withColumns(cols)
