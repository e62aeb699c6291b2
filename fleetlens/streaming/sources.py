"""Streaming sources: JSON record files or Kafka topics, explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.schemas import FARE_EVENT, LOCATION_EVENT
from fleetlens.sources import codec

# Topic names of the record streams and of the published outputs.
LOCATION_TOPIC = "matatu.location"
FARE_TOPIC = "matatu.fares"
OUTPUT_TOPICS = {
    "speed_alerts": "matatu.speed.alerts",
    "location_enriched": "matatu.location.enriched",
    "fares_failed": "matatu.fares.failed",
    "sacco_revenue": "matatu.sacco.revenue",
    "offgrid_alerts": "matatu.offgrid.alerts",
    "route_occupancy": "matatu.route.occupancy",
}

# Optional ordering field carried next to the record (source offset stand-in).
EVENT_ID = T.StructField("eventId", T.LongType())


def with_event_id(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, EVENT_ID])


def json_file_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = 100
) -> DataFrame:
    """Records from JSON-lines files appearing under ``path`` (each file is
    read once; existing files are read first, as with an earliest start).
    Adds ``_malformed`` (the line did not parse as a record)."""
    corrupt = "_corrupt_record"
    with_corrupt = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    reader = (
        spark.readStream.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # a line that is not a record is kept, flagged, and quarantined downstream
    return reader.json(path).withColumn("_malformed", F.col(corrupt).isNotNull()).drop(corrupt)


def location_file_stream(spark: SparkSession, path: str, **kw) -> DataFrame:
    return json_file_stream(spark, path, with_event_id(LOCATION_EVENT), **kw)


def fare_file_stream(spark: SparkSession, path: str, **kw) -> DataFrame:
    return json_file_stream(spark, path, with_event_id(FARE_EVENT), **kw)


def kafka_stream(
    spark: SparkSession,
    bootstrap: str,
    topic: str,
    schema: T.StructType,
    max_offsets_per_trigger: int,
) -> DataFrame:
    """Records from a Kafka topic, read from the earliest offset, at most
    ``max_offsets_per_trigger`` a micro-batch: the stateful steps gather a
    key's rows of one micro-batch, so the bound is required. Needs the
    Kafka connector on the classpath. ``eventId`` is the record offset; the
    Kafka record metadata columns are kept."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    )
    return decode_kafka_records(reader.load(), schema)


def decode_kafka_records(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Kafka rows (binary key/value, partition, offset, timestamp) -> record
    columns plus key, partition, offset, ``recordTimestamp`` and ``eventId``
    (= offset, the order within a partition). Works on batch and stream."""
    records = raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition",
        "offset",
        F.col("timestamp").alias("recordTimestamp"),
    )
    return codec.decode(records, schema).withColumn("eventId", F.col("offset"))
