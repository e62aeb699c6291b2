"""Location and fare views derived from the driver's ``events`` table.

``event_id`` stands in for the source offset and breaks ties in event order.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.scalar import to_kes
from fleetlens.sources.codec import FARE_FIELDS, LOCATION_FIELDS, encode_keyed

# The mapping rules from ``events`` rows to transit records.
LOCATION_TYPES = ("click", "view", "error")
FARE_TYPES = ("purchase", "signup")
FIXTURE_ROUTES = ("route_33", "route_23", "route_58", "route_111", "route_46")
UNKNOWN_ROUTE = "route_99"
UNKNOWN_ROUTE_EVERY = 7  # event_id % 7 == 0 pings the unknown route
PASSENGER_MODULUS = 34
PAYMENT_METHOD_BY_MOD3 = ("MPESA", "CASH", "CARD")
LATE_EVERY = 13  # event_id % 13 == 0 arrives two hours late
LATE_BY_HOURS = 2
BASE_LATITUDE = -1.2921
BASE_LONGITUDE = 36.8219

_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


# Where a record stands in its source: file and row of the file.
SOURCE_PLACE = ["partition", "offset"]


def with_source_place(rows: DataFrame) -> DataFrame:
    """``rows`` read from Parquet files, each with its file's name and its row
    number there, from the reader's hidden ``_metadata``."""
    return rows.select(
        "*", F.col("_metadata.file_name").alias("partition"), F.col("_metadata.row_index").alias("offset")
    )


def _props_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _matatu_id() -> Column:
    return F.concat(F.lit("KBZ "), F.col("user_id").cast("string"))


def locations_view(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """GPS pings: LocationEvent fields plus ``eventId`` and the columns ``keep``."""
    keep = keep or []
    routes = F.array(*[F.lit(r) for r in FIXTURE_ROUTES])
    route_id = F.when(F.col("event_id") % UNKNOWN_ROUTE_EVERY == 0, F.lit(UNKNOWN_ROUTE)).otherwise(
        F.element_at(routes, (F.col("user_id") % len(FIXTURE_ROUTES) + 1).cast("int"))
    )
    offset = F.col("value") / F.lit(10000.0)
    return (
        events.filter(F.col("event_type").isin(*LOCATION_TYPES))
        .select(
            _matatu_id().alias("matatuId"),
            route_id.alias("routeId"),
            F.col("value").alias("speedKmh"),
            (F.lit(BASE_LATITUDE) + offset).alias("latitude"),
            (F.lit(BASE_LONGITUDE) + offset).alias("longitude"),
            (_props_k() % PASSENGER_MODULUS).alias("passengersOnboard"),
            F.col("ts").alias("timestamp"),
            F.col("event_id").alias("eventId"),
            *keep,
        )
        .withColumn(
            "routeName", F.concat(F.lit("Route "), F.regexp_replace("routeId", "^route_", ""))
        )
        .select(
            "matatuId",
            "routeId",
            "routeName",
            "latitude",
            "longitude",
            "speedKmh",
            "passengersOnboard",
            "timestamp",
            "eventId",
            *keep,
        )
    )


def fares_view(events: DataFrame) -> DataFrame:
    """Fare payments: FareEvent fields plus ``eventId`` and ``arrivalTs``.

    ``arrivalTs`` is the order in which the fare reaches the stream; every
    13th fare arrives two hours after its event time.
    """
    eid = F.col("event_id")
    status = F.when(eid % 10 == 0, "FAILED").when(eid % 10 == 1, "PENDING").otherwise("SUCCESS")
    method = F.element_at(
        F.array(*[F.lit(m) for m in PAYMENT_METHOD_BY_MOD3]), (eid % 3 + 1).cast("int")
    )
    arrival = F.when(
        eid % LATE_EVERY == 0, F.col("ts") + F.expr(f"INTERVAL {LATE_BY_HOURS} HOURS")
    ).otherwise(F.col("ts"))
    return events.filter(F.col("event_type").isin(*FARE_TYPES)).select(
        F.concat(F.lit("TXN-"), eid.cast("string")).alias("transactionId"),
        _matatu_id().alias("matatuId"),
        F.concat(F.lit("PAX-"), _props_k().cast("string")).alias("passengerId"),
        to_kes(F.col("value").cast(T.DecimalType(12, 2))).alias("amountKes"),
        method.alias("paymentMethod"),
        status.alias("status"),
        F.col("ts").alias("timestamp"),
        eid.alias("eventId"),
        arrival.alias("arrivalTs"),
    )


def load_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations_view(load_events(spark, sf_dir))


def load_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fares_view(load_events(spark, sf_dir))


# Of every 50 events, which carry a broken payload (event_id
# modulo 50), and the text of one that is not a record.
BROKEN_EVERY = 50
NOT_A_RECORD = "{not a record"


def _fault(k: int) -> Column:
    return F.pmod("eventId", F.lit(BROKEN_EVERY)) == k


def broken_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed location payloads, a fixed share of them broken: blank vehicle
    (1), empty route (2), negative speed (3), no JSON (4); and without a
    passenger count (5), which is valid."""
    locs = load_locations(spark, sf_dir)
    bad = (
        locs.withColumn("matatuId", F.when(_fault(1), F.lit("  ")).otherwise(F.col("matatuId")))
        .withColumn("routeId", F.when(_fault(2), F.lit("")).otherwise(F.col("routeId")))
        .withColumn("speedKmh", F.when(_fault(3), -F.col("speedKmh") - 1).otherwise(F.col("speedKmh")))
        .withColumn("passengersOnboard", F.when(~_fault(5), F.col("passengersOnboard")))
    )
    return _payloads(bad, "routeId", LOCATION_FIELDS)


def broken_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed fare payloads: unknown method (1), unknown status (2), missing
    method (3), no JSON (4)."""
    bad = (
        load_fares(spark, sf_dir)
        .withColumn("paymentMethod", F.when(_fault(1), F.lit("BARTER")).when(~_fault(3), F.col("paymentMethod")))
        .withColumn("status", F.when(_fault(2), F.lit("LOST")).otherwise(F.col("status")))
    )
    return _payloads(bad, "matatuId", FARE_FIELDS)


def _payloads(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    keyed = encode_keyed(rows, key, fields, keep=[F.col("eventId"), F.col("eventId").alias("offset")])
    value = F.when(_fault(4), F.lit(NOT_A_RECORD)).otherwise(F.col("value"))
    return keyed.withColumn("value", value).drop("eventId")


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views ``locations``, ``fares`` and ``sacco_dim`` for Spark SQL."""
    from fleetlens.sources.dimension import sacco_dim

    events = load_events(spark, sf_dir)
    locations_view(events).createOrReplaceTempView("locations")
    fares_view(events).createOrReplaceTempView("fares")
    sacco_dim(spark).createOrReplaceTempView("sacco_dim")
