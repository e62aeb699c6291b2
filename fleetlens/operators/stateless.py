"""Stateless transforms: filters, projections, the dimension lookup join.

All of them are narrow (no shuffle) except the unknown-route report, whose
grouped count is a partial + final aggregation over few keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.scalar import status_icon
from fleetlens.operators import taps
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings
from fleetlens.sources.dimension import UNKNOWN_SACCO


def speed_alerts(locations: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Pings strictly above the speed threshold (same record shape)."""
    return locations.filter(F.col("speedKmh") > F.lit(settings.speed_threshold_kmh))


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    defaults: dict[str, str],
    small_dim: bool = False,
) -> DataFrame:
    """Left-outer equi join to a dimension with a default for misses.

    ``small_dim`` is the caller's proof that the dimension is a handful of
    rows: it is then hinted for broadcast. Otherwise the planner decides by
    measured size.
    """
    right = dim.select(key, *[F.col(c).alias(f"_dim_{c}") for c in defaults])
    if small_dim:
        right = F.broadcast(right)
    joined = facts.join(right, on=key, how="left")
    for c, default in defaults.items():
        joined = joined.withColumn(c, F.coalesce(F.col(f"_dim_{c}"), F.lit(default)))
    return joined.drop(*[f"_dim_{c}" for c in defaults])


def enrich_locations(
    locations: DataFrame,
    dim: DataFrame,
    settings: JobSettings = DEFAULT_SETTINGS,
    small_dim: bool = False,
    clock: Column | None = None,
) -> DataFrame:
    """Pings joined to their operator; misses get the unknown-operator default.

    ``clock`` supplies ``enrichedAt`` (processing time in the stream); batch
    replays leave it out so results are reproducible.
    """
    sacco_id, sacco_name, terminus = UNKNOWN_SACCO
    joined = lookup_join(
        locations,
        dim,
        "routeId",
        {"saccoId": sacco_id, "saccoName": sacco_name, "terminus": terminus},
        small_dim,
    )
    extra = [c for c in ("eventId",) if c in locations.columns]
    cols = [
        "matatuId",
        "routeId",
        "routeName",
        "saccoName",
        "saccoId",
        "terminus",
        "latitude",
        "longitude",
        "speedKmh",
        "passengersOnboard",
        (F.col("speedKmh") > F.lit(settings.speed_threshold_kmh)).alias("isSpeeding"),
        F.col("timestamp").alias("originalTimestamp"),
        *extra,
    ]
    if clock is not None:
        cols.append(clock.alias("enrichedAt"))
    return joined.select(*cols)


def unknown_routes(locations: DataFrame, dim: DataFrame, small_dim: bool = False) -> DataFrame:
    """Routes that have no dimension row: pings, vehicles, first/last seen."""
    right = dim.select("routeId")
    if small_dim:
        right = F.broadcast(right)
    return (
        locations.join(right, "routeId", "left_anti")
        .groupBy("routeId")
        .agg(
            F.count(F.lit(1)).alias("pings"),
            F.count_distinct("matatuId").alias("vehicles"),
            F.min("timestamp").alias("firstSeen"),
            F.max("timestamp").alias("lastSeen"),
        )
    )


def display_board(records: DataFrame) -> DataFrame:
    """Payload plus the record metadata the source has: key, offset, record
    time, and the partition where records come from a partitioned log."""
    return records.select(
        "matatuId",
        "routeId",
        "routeName",
        "latitude",
        "longitude",
        "speedKmh",
        "passengersOnboard",
        *[c for c in ("partition",) if c in records.columns],
        F.col("key"),
        F.col("offset"),
        F.col("recordTimestamp"),
    )


def fare_log(fares: DataFrame) -> DataFrame:
    """Status icon plus the six logged fare fields and the log line."""
    extra = [c for c in ("eventId",) if c in fares.columns]
    return (
        fares.select(
            status_icon(F.col("status")).alias("icon"),
            "transactionId",
            "matatuId",
            "amountKes",
            "paymentMethod",
            "status",
            *extra,
        )
        .withColumn("message", taps.fare_log_message(F.col("icon")))
    )


def location_audit(locations: DataFrame) -> DataFrame:
    """Rows persisted by the audit logger, with the partition date column."""
    extra = [c for c in ("eventId",) if c in locations.columns]
    return locations.select(
        "matatuId",
        "routeId",
        "latitude",
        "longitude",
        "speedKmh",
        *extra,
        F.to_date("timestamp").alias("eventDate"),
    )
