"""Registered batch queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver tables (``events``) through the fixture views and runs
one operator over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.operators import occupancy, offgrid, revenue, routing, stateless, taps
from fleetlens.settings import DEFAULT_SETTINGS
from fleetlens.schemas import OFFGRID_ALERT, ROUTE_OCCUPANCY, SACCO_REVENUE_WINDOW
from fleetlens.sources import codec, fixtures
from fleetlens.sources.codec import FARE_FIELDS, LOCATION_FIELDS
from fleetlens.sources.dimension import sacco_dim
from fleetlens.sources.fixtures import broken_fares, broken_locations, load_fares, load_locations
from fleetlens.streaming import jobs
from fleetlens.streaming.sinks import keyed_records

S = DEFAULT_SETTINGS
# One check an hour: every vehicle and the whole period, a row per alert.
HOURLY = S.with_(offgrid_check_interval_ms=3_600_000)


def location_source(spark: SparkSession, sf: str) -> DataFrame:
    return load_locations(spark, sf)


def fare_source(spark: SparkSession, sf: str) -> DataFrame:
    return load_fares(spark, sf)


def speed_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return stateless.speed_alerts(load_locations(spark, sf), S)


def speed_alert_messages(spark: SparkSession, sf: str) -> DataFrame:
    alerts = stateless.speed_alerts(load_locations(spark, sf), S)
    return taps.speed_alert_messages(alerts, S).select("matatuId", "eventId", "message")


def enriched_locations(spark: SparkSession, sf: str) -> DataFrame:
    return stateless.enrich_locations(
        load_locations(spark, sf), sacco_dim(spark), S, small_dim=True
    )


def enrichment_messages(spark: SparkSession, sf: str) -> DataFrame:
    enriched = enriched_locations(spark, sf)
    return taps.enrichment_messages(enriched).select("matatuId", "eventId", "message")


def unknown_routes(spark: SparkSession, sf: str) -> DataFrame:
    return stateless.unknown_routes(
        load_locations(spark, sf), sacco_dim(spark), small_dim=True
    )


def fare_branches(spark: SparkSession, sf: str) -> DataFrame:
    return routing.label_branches(load_fares(spark, sf)).drop("arrivalTs")


def failed_fares(spark: SparkSession, sf: str) -> DataFrame:
    return routing.failed_fares(load_fares(spark, sf)).drop("arrivalTs")


def fare_branch_messages(spark: SparkSession, sf: str) -> DataFrame:
    labelled = routing.label_branches(load_fares(spark, sf))
    return taps.fare_branch_messages(labelled).select("transactionId", "branch", "message")


def fare_branch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return routing.branch_summary(load_fares(spark, sf))


def _keyed_locations(spark: SparkSession, sf: str) -> DataFrame:
    return codec.encode_keyed(
        load_locations(spark, sf), "routeId", LOCATION_FIELDS, keep=[F.col("eventId").alias("offset")]
    )


def location_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Encode to keyed JSON records and decode back; valid rows only."""
    decoded = codec.decode(
        _keyed_locations(spark, sf), codec.with_ntz_timestamps(codec.LOCATION_EVENT)
    )
    valid, _ = codec.split_valid(decoded, "location")
    return valid.withColumnRenamed("offset", "eventId").drop("key")


def _ingested_locations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    decoded = codec.decode(broken_locations(spark, sf), codec.with_ntz_timestamps(codec.LOCATION_EVENT))
    return codec.split_valid(decoded, "location")


def location_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The valid records of a feed with a fixed share of broken payloads."""
    valid, _ = _ingested_locations(spark, sf)
    return valid.withColumnRenamed("offset", "eventId").drop("key")


def location_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = _ingested_locations(spark, sf)
    return bad.select(F.col("offset").alias("eventId"), "matatuId", "routeId", "invalidReason")


def _keyed_fares(spark: SparkSession, sf: str) -> DataFrame:
    return codec.encode_keyed(
        load_fares(spark, sf), "matatuId", FARE_FIELDS, keep=[F.col("eventId").alias("offset")]
    )


def fare_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    decoded = codec.decode(broken_fares(spark, sf), codec.with_ntz_timestamps(codec.FARE_EVENT))
    _, bad = codec.split_valid(decoded, "fare")
    return bad.select(F.col("offset").alias("eventId"), "transactionId", "invalidReason")


def fare_decode(spark: SparkSession, sf: str) -> DataFrame:
    decoded = codec.decode(_keyed_fares(spark, sf), codec.with_ntz_timestamps(codec.FARE_EVENT))
    valid, _ = codec.split_valid(decoded, "fare")
    return valid.withColumnRenamed("offset", "eventId").drop("key")


def display_board(spark: SparkSession, sf: str) -> DataFrame:
    """Board lines with what the source itself says of a record: the file it
    is in stands for the partition, its row number there for the offset."""
    records = fixtures.with_source_place(fixtures.load_events(spark, sf))
    locs = fixtures.locations_view(records, keep=fixtures.SOURCE_PLACE)
    return stateless.display_board(
        locs.select("*", F.col("routeId").alias("key"), F.col("timestamp").alias("recordTimestamp"))
    )


def fare_log(spark: SparkSession, sf: str) -> DataFrame:
    return stateless.fare_log(load_fares(spark, sf))


def location_audit(spark: SparkSession, sf: str) -> DataFrame:
    return stateless.location_audit(load_locations(spark, sf))


def operator_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """Operator each vehicle's fares are credited to (one row per vehicle)."""
    fares = load_fares(spark, sf).select("matatuId").distinct()
    return revenue.assign_operator(fares, S)


def sacco_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return revenue.windowed_revenue(load_fares(spark, sf), S)


def sacco_revenue_by_sacco_id(spark: SparkSession, sf: str) -> DataFrame:
    """Windowed revenue keyed by sacco id (the documented key mode)."""
    return revenue.windowed_revenue(load_fares(spark, sf), S.with_(revenue_key_mode="sacco"))


def sacco_revenue_messages(spark: SparkSession, sf: str) -> DataFrame:
    rev = revenue.windowed_revenue(load_fares(spark, sf), S)
    return taps.revenue_messages(rev).select("saccoId", "windowStart", "message")


def late_fares(spark: SparkSession, sf: str) -> DataFrame:
    return revenue.late_fares(load_fares(spark, sf), S)


def sacco_revenue_emitted(spark: SparkSession, sf: str) -> DataFrame:
    return revenue.emitted_revenue(load_fares(spark, sf), S)


def passenger_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return occupancy.passenger_deltas(load_locations(spark, sf), S)


def vehicle_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return occupancy.vehicle_snapshots(load_locations(spark, sf))


def route_occupancy_changelog(spark: SparkSession, sf: str) -> DataFrame:
    deltas = occupancy.passenger_deltas(load_locations(spark, sf), S)
    return occupancy.occupancy_changelog(deltas, S)


def route_occupancy_messages(spark: SparkSession, sf: str) -> DataFrame:
    log = route_occupancy_changelog(spark, sf)
    return taps.occupancy_messages(log).select("routeId", "eventId", "message")


def route_occupancy(spark: SparkSession, sf: str) -> DataFrame:
    deltas = occupancy.passenger_deltas(load_locations(spark, sf), S)
    return occupancy.route_occupancy(deltas, S)


def last_seen(spark: SparkSession, sf: str) -> DataFrame:
    return offgrid.last_seen(load_locations(spark, sf))


def offgrid_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return offgrid.offgrid_as_of(load_locations(spark, sf), None, S)


def offgrid_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return offgrid.silence_gaps(load_locations(spark, sf), None, S)


def offgrid_tick_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The alert rows of every hourly check over the whole period."""
    return offgrid.tick_alerts(load_locations(spark, sf), None, HOURLY)


def offgrid_messages(spark: SparkSession, sf: str) -> DataFrame:
    alerts = offgrid.tick_alerts(load_locations(spark, sf), None, HOURLY, of_gap=taps.OFF_GRID_PARTS)
    lines = taps.offgrid_messages(alerts)
    return lines.select("matatuId", "alertRaisedAt", "message")


def delta_messages(spark: SparkSession, sf: str) -> DataFrame:
    return taps.delta_messages(passenger_deltas(spark, sf)).select("matatuId", "eventId", "message")


def location_log_messages(spark: SparkSession, sf: str) -> DataFrame:
    return taps.location_log_messages(load_locations(spark, sf)).select("matatuId", "eventId", "message")


def _opened(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Published records with their field names and the payload parsed back."""
    return records.select(
        "key",
        F.array_join(F.json_object_keys("value"), ",").alias("fields"),
        F.inline(F.array(F.from_json("value", codec.with_ntz_timestamps(schema), {"timestampNTZFormat": codec.ISO_LOCAL}))),
    )


def speed_alert_records(spark: SparkSession, sf: str) -> DataFrame:
    """Speed alerts as published: keyed by route, only the record's fields."""
    return _opened(keyed_records(speed_alerts(spark, sf), "routeId", LOCATION_FIELDS), codec.LOCATION_EVENT)


def failed_fare_records(spark: SparkSession, sf: str) -> DataFrame:
    return _opened(keyed_records(failed_fares(spark, sf), "matatuId", FARE_FIELDS), codec.FARE_EVENT)


def enriched_records(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched pings as published; the clock is the ping's own time."""
    rows = stateless.enrich_locations(load_locations(spark, sf), sacco_dim(spark), S, small_dim=True, clock=F.col("timestamp"))
    return _opened(keyed_records(rows, "routeId", jobs.ENRICHED_FIELDS), ENRICHED_RECORD)


def revenue_records(spark: SparkSession, sf: str) -> DataFrame:
    """Emitted revenue windows as published; computed at their end."""
    rows = sacco_revenue_emitted(spark, sf).withColumn("computedAt", F.col("windowEnd"))
    schema = T.StructType([*codec.with_ntz_timestamps(SACCO_REVENUE_WINDOW).fields, T.StructField("computedAt", T.TimestampNTZType())])
    return _opened(keyed_records(rows, "saccoId", jobs.REVENUE_FIELDS), schema)


def occupancy_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every route occupancy update as published; updated at the ping's time."""
    rows = route_occupancy_changelog(spark, sf).withColumn("lastUpdated", F.col("timestamp"))
    return _opened(keyed_records(rows, "routeId", jobs.OCCUPANCY_FIELDS), ROUTE_OCCUPANCY)


def offgrid_records(spark: SparkSession, sf: str) -> DataFrame:
    """Off-grid alerts of hourly checks as published, keyed by vehicle."""
    return _opened(keyed_records(offgrid_tick_alerts(spark, sf), "matatuId", jobs.OFFGRID_FIELDS), OFFGRID_ALERT)


ENRICHED_RECORD = T.StructType(
    [T.StructField(f, T.StringType()) for f in jobs.ENRICHED_FIELDS[:6]]
    + [T.StructField(f, T.DoubleType()) for f in jobs.ENRICHED_FIELDS[6:9]]
    + [T.StructField("passengersOnboard", T.IntegerType()), T.StructField("isSpeeding", T.BooleanType())]
    + [T.StructField(f, T.TimestampNTZType()) for f in jobs.ENRICHED_FIELDS[11:]]
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "location_source": location_source,
    "fare_source": fare_source,
    "speed_alerts": speed_alerts,
    "speed_alert_messages": speed_alert_messages,
    "enriched_locations": enriched_locations,
    "enrichment_messages": enrichment_messages,
    "unknown_routes": unknown_routes,
    "fare_branches": fare_branches,
    "failed_fares": failed_fares,
    "fare_branch_messages": fare_branch_messages,
    "fare_branch_summary": fare_branch_summary,
    "location_decode": location_decode,
    "location_quarantine": location_quarantine,
    "fare_quarantine": fare_quarantine,
    "fare_decode": fare_decode,
    "display_board": display_board,
    "fare_log": fare_log,
    "location_audit": location_audit,
    "operator_assignment": operator_assignment,
    "sacco_revenue": sacco_revenue,
    "sacco_revenue_by_sacco_id": sacco_revenue_by_sacco_id,
    "sacco_revenue_messages": sacco_revenue_messages,
    "late_fares": late_fares,
    "sacco_revenue_emitted": sacco_revenue_emitted,
    "passenger_deltas": passenger_deltas,
    "vehicle_snapshots": vehicle_snapshots,
    "route_occupancy_changelog": route_occupancy_changelog,
    "route_occupancy_messages": route_occupancy_messages,
    "route_occupancy": route_occupancy,
    "last_seen": last_seen,
    "offgrid_as_of": offgrid_as_of,
    "offgrid_gaps": offgrid_gaps,
    "offgrid_tick_alerts": offgrid_tick_alerts,
    "offgrid_messages": offgrid_messages,
    "delta_messages": delta_messages,
    "location_log_messages": location_log_messages,
    "location_ingest": location_ingest,
    "speed_alert_records": speed_alert_records,
    "failed_fare_records": failed_fare_records,
    "enriched_records": enriched_records,
    "revenue_records": revenue_records,
    "occupancy_records": occupancy_records,
    "offgrid_records": offgrid_records,
}

FLAGSHIP = "sacco_revenue"
