"""Silent-vehicle (off-grid) detection in batch.

The streaming detector checks every vehicle's last ping at each tick of a
fixed interval and alerts while ``tick - lastSeen > threshold`` (strict, in
whole milliseconds), at every tick, until the vehicle pings again. Replayed
over stored pings with event time as the clock:

* :func:`last_seen` (A4) - latest ping per vehicle.
* :func:`offgrid_as_of` (W3) - the alerts a single tick at ``as_of`` raises.
* :func:`silence_gaps` (W4) - each gap between consecutive pings of a vehicle
  with the ticks that alert inside it, counted by arithmetic (no per-tick
  rows). The last gap runs to ``horizon``.
* :func:`tick_alerts` - the per-tick alert rows themselves.

Ticks are epoch-aligned multiples of the check interval; a tick at t sees the
pings with timestamp <= t.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.scalar import (
    ceil_div,
    epoch_micros,
    epoch_millis,
    floor_div,
    from_epoch_micros,
)
from fleetlens.operators import scan
from fleetlens.operators.latest_row import latest_rows
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings

ORDER = ["timestamp", "eventId"]


def _is_ntz(df: DataFrame) -> bool:
    return df.schema["timestamp"].dataType.typeName() == "timestamp_ntz"


def max_event_time(locations: DataFrame) -> Column:
    """Latest ping time as a scalar subquery (evaluated once, no join)."""
    return locations.select(F.max("timestamp")).scalar()


TEXTS, NUMBERS = ["routeId", "routeName"], ["latitude", "longitude"]


def last_seen(locations: DataFrame) -> DataFrame:
    return latest_rows(locations, "matatuId", TEXTS, NUMBERS).select(
        "matatuId",
        "routeId",
        "routeName",
        F.col("latitude").alias("lastLatitude"),
        F.col("longitude").alias("lastLongitude"),
        F.col("timestamp").alias("lastSeenAt"),
    )


def offgrid_as_of(
    locations: DataFrame, as_of: Column | None = None, settings: JobSettings = DEFAULT_SETTINGS
) -> DataFrame:
    """Alerts raised by one check at ``as_of`` (default: latest ping time)."""
    as_of = max_event_time(locations) if as_of is None else as_of
    # bind the instant once as a column so a scalar subquery runs once
    rows = locations.withColumn("_now", as_of).filter(F.col("timestamp") <= F.col("_now"))
    seen = last_seen(rows.drop("_now")).withColumn("_now", as_of)
    silence = epoch_millis(seen, "_now") - epoch_millis(seen, "lastSeenAt")
    return (
        seen.withColumn("silenceDurationMs", silence)
        .filter(F.col("silenceDurationMs") > F.lit(settings.offgrid_silence_ms))
        .select(
            "matatuId",
            "routeId",
            "routeName",
            F.col("lastLatitude").alias("lastKnownLatitude"),
            F.col("lastLongitude").alias("lastKnownLongitude"),
            "silenceDurationMs",
            "lastSeenAt",
            F.col("_now").alias("alertRaisedAt"),
        )
    )


def _gaps(locations: DataFrame, settings: JobSettings) -> DataFrame:
    """Every ping with the time of the vehicle's next ping (null if last)."""
    cols = ["matatuId", "routeId", "routeName", "latitude", "longitude", "timestamp", "eventId"]
    rows = scan.with_cuts(locations.select(*cols), "matatuId", ORDER, settings.vehicle_chunk_seconds, settings)
    first = scan.chunk_edges(rows, ORDER, "first")
    carry = first.select(scan.KEY, scan.CHUNK, F.lead("_rec").over(scan.over_chunks()).alias("_carry"))
    rows = rows.withColumn("_next", F.lead("timestamp").over(scan.in_chunk(ORDER)))
    return scan.join_carry(rows, carry).withColumn(
        "nextSeenAt", F.coalesce("_next", "_carry.timestamp")
    )


def silence_gaps(
    locations: DataFrame,
    horizon: Column | None = None,
    settings: JobSettings = DEFAULT_SETTINGS,
    only_alerting: bool = True,
    keep_ticks: bool = False,
) -> DataFrame:
    """One row per gap after a ping with its alerting ticks.

    First alerting tick: the first multiple of the interval strictly more than
    ``threshold`` ms after the last ping. Last: the last multiple before the
    next ping (or at/before ``horizon`` for a vehicle's final ping).
    """
    ntz = _is_ntz(locations)
    horizon = max_event_time(locations) if horizon is None else horizon
    g = _gaps(locations, settings).withColumn("_h", horizon)
    step = settings.offgrid_check_interval_ms
    last_ms = epoch_millis(g, "timestamp")
    next_us = epoch_micros(g, "nextSeenAt")
    h_us = epoch_micros(g, "_h")
    first_k = ceil_div(last_ms + F.lit(settings.offgrid_silence_ms + 1), step)
    last_k = F.when(
        F.col("nextSeenAt").isNotNull(), floor_div(next_us - F.lit(1), step * 1000)
    ).otherwise(floor_div(h_us, step * 1000))
    g = (
        g.withColumn("_last_ms", last_ms)
        .withColumn("_k1", first_k)
        .withColumn("_k2", last_k)
        .withColumn("alertCount", F.greatest(F.lit(0), F.col("_k2") - F.col("_k1") + 1).cast("bigint"))
    )
    if only_alerting:
        g = g.filter(F.col("alertCount") > 0)
    tick_ts = lambda k: from_epoch_micros(F.col(k) * F.lit(step * 1000), ntz)
    internal = ["_k1", "_k2", "_last_ms"] if keep_ticks else []
    return g.select(
        "matatuId",
        "routeId",
        "routeName",
        F.col("latitude").alias("lastKnownLatitude"),
        F.col("longitude").alias("lastKnownLongitude"),
        F.col("timestamp").alias("lastSeenAt"),
        "nextSeenAt",
        "eventId",
        tick_ts("_k1").alias("firstAlertAt"),
        tick_ts("_k2").alias("lastAlertAt"),
        "alertCount",
        (F.col("_k2") * F.lit(step) - F.col("_last_ms")).alias("maxSilenceMs"),
        *internal,
    )


def tick_alerts(
    locations: DataFrame,
    horizon: Column | None = None,
    settings: JobSettings = DEFAULT_SETTINGS,
    of_gap: dict[str, Callable[[DataFrame], Column]] | None = None,
) -> DataFrame:
    """One alert row per (vehicle, alerting tick), as the detector emits them.

    Each gap expands to its own ticks inside the task that holds it; the
    output is as large as the detector's output, and no more. A gap may make
    hundreds of alerts, so gaps are first spread over tasks for as many: Spark
    would size the tasks by the gaps and leave few. ``of_gap`` adds
    columns that are the same for all alerts of a gap: they are computed once
    for the gap, before it expands.
    """
    ntz = _is_ntz(locations)
    step = settings.offgrid_check_interval_ms
    gaps = silence_gaps(locations, horizon, settings, keep_ticks=True)
    of_gap = of_gap or {}
    gaps = gaps.withColumns({name: column(gaps) for name, column in of_gap.items()})
    spark = locations.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    gaps = gaps.repartition(tasks, "matatuId", "lastSeenAt")
    ticks = gaps.withColumn("_k", F.explode(F.sequence("_k1", "_k2")))
    return ticks.select(
        "matatuId",
        "routeId",
        "routeName",
        "lastKnownLatitude",
        "lastKnownLongitude",
        (F.col("_k") * F.lit(step) - F.col("_last_ms")).alias("silenceDurationMs"),
        "lastSeenAt",
        from_epoch_micros(F.col("_k") * F.lit(step * 1000), ntz).alias("alertRaisedAt"),
        *of_gap,
    )

