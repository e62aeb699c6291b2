"""Keyed state of running flows as tables.

What the flows remember - the last ping of every vehicle, its passenger count,
the totals of every route, each operator's clock and open windows - stands in
state stores below the flows' checkpoints. The ``statestore`` data source reads
them without touching the running query: the state as of its last committed
micro-batch, or of ``batch_id``. State is read by all executors, a row a key;
vehicles, which are held in groups, are taken out of their groups again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.scalar import from_epoch_micros
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings


# Names Spark gives the stateful steps in a checkpoint's metadata.
KEYED, PROCESSOR = "applyInPandasWithState", "transformWithState"


def _state(spark: SparkSession, checkpoint: str, batch_id: int | None, kind: str, **options) -> DataFrame:
    """State of the flow's only step of ``kind``. Steps are numbered by the
    planner, so the number is looked up in the checkpoint's metadata."""
    steps = spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorName").distinct().collect()
    found = {r.operatorId for r in steps if r.operatorName.startswith(kind)}
    if len(found) != 1:
        raise ValueError(f"{checkpoint} has {len(found)} steps of kind {kind}")
    reader = spark.read.format("statestore").option("operatorId", str(found.pop()))
    for k, v in {**options, **({"batchId": batch_id} if batch_id is not None else {})}.items():
        reader = reader.option(k, str(v))
    return reader.load(checkpoint)


def _members(groups: DataFrame, value: str) -> DataFrame:
    """A row for each key of a group, whose state is parallel arrays."""
    arrays = groups.select(f"{value}.*")
    return arrays.select(F.inline(F.arrays_zip(*arrays.columns)))


def last_seen(spark: SparkSession, checkpoint: str, ntz: bool = False, batch_id: int | None = None) -> DataFrame:
    """Last ping of every vehicle, from the event-time off-grid flow."""
    rows = _members(_state(spark, checkpoint, batch_id, PROCESSOR, stateVarName="lastSeen"), "value")
    return rows.select(
        "matatuId", "routeId", "routeName", F.col("latitude").alias("lastLatitude"), F.col("longitude").alias("lastLongitude"),
        from_epoch_micros(F.col("seen"), ntz).alias("lastSeenAt"),
    )


def vehicle_counts(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Last route and passenger count of every vehicle, from the delta step."""
    return _members(_state(spark, checkpoint, batch_id, KEYED), "value.groupState")


def route_totals(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Occupancy and running totals of every route, from the occupancy step."""
    rows = _state(spark, checkpoint, batch_id, PROCESSOR, stateVarName="occupancy")
    return rows.select(F.col("key.routeId").alias("routeId"), "value.*")


def operator_clocks(spark: SparkSession, checkpoint: str, ntz: bool = False, batch_id: int | None = None) -> DataFrame:
    """Stream time of every operator, from the stream-time revenue flow."""
    rows = _state(spark, checkpoint, batch_id, PROCESSOR, stateVarName="streamTime")
    return rows.select(F.col("key.saccoId").alias("saccoId"), from_epoch_micros(F.col("value.t"), ntz).alias("streamTime"))


def open_windows(
    spark: SparkSession, checkpoint: str, ntz: bool = False, settings: JobSettings = DEFAULT_SETTINGS, batch_id: int | None = None
) -> DataFrame:
    """Revenue so far of the windows that have not closed."""
    rows = _state(spark, checkpoint, batch_id, PROCESSOR, stateVarName="openWindows")
    start = F.col("user_map_key.start")
    return rows.select(
        F.col("key.saccoId").alias("saccoId"),
        (F.col("user_map_value.cents").cast("decimal(20,0)") / F.lit(100)).cast("decimal(18,2)").alias("totalRevenueKes"),
        F.col("user_map_value.fares").alias("transactionCount"),
        from_epoch_micros(start, ntz).alias("windowStart"),
        from_epoch_micros(start + F.lit(settings.revenue_window_ms * 1000), ntz).alias("windowEnd"),
    )
