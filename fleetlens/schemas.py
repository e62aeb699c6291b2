"""Explicit record schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Accepted enum values.
PAYMENT_METHODS = ("MPESA", "CASH", "CARD")
PAYMENT_STATUSES = ("SUCCESS", "FAILED", "PENDING")

LOCATION_EVENT = T.StructType(
    [
        T.StructField("matatuId", T.StringType()),
        T.StructField("routeId", T.StringType()),
        T.StructField("routeName", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("speedKmh", T.DoubleType()),
        T.StructField("passengersOnboard", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

FARE_EVENT = T.StructType(
    [
        T.StructField("transactionId", T.StringType()),
        T.StructField("matatuId", T.StringType()),
        T.StructField("passengerId", T.StringType()),
        T.StructField("amountKes", T.DecimalType(18, 2)),
        T.StructField("paymentMethod", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

SACCO_INFO = T.StructType(
    [
        T.StructField("routeId", T.StringType(), False),
        T.StructField("saccoId", T.StringType(), False),
        T.StructField("saccoName", T.StringType(), False),
        T.StructField("terminus", T.StringType(), False),
    ]
)

DELTA_EVENT = T.StructType(
    [
        T.StructField("matatuId", T.StringType()),
        T.StructField("routeId", T.StringType()),
        T.StructField("routeName", T.StringType()),
        T.StructField("passengerDelta", T.IntegerType()),
        T.StructField("boardings", T.IntegerType()),
        T.StructField("alightings", T.IntegerType()),
    ]
)

ROUTE_OCCUPANCY = T.StructType(
    [
        T.StructField("routeId", T.StringType()),
        T.StructField("routeName", T.StringType()),
        T.StructField("currentPassengers", T.IntegerType()),
        T.StructField("totalBoardings", T.LongType()),
        T.StructField("totalAlightings", T.LongType()),
        T.StructField("lastUpdated", T.TimestampType()),
    ]
)

OFFGRID_ALERT = T.StructType(
    [
        T.StructField("matatuId", T.StringType()),
        T.StructField("routeId", T.StringType()),
        T.StructField("routeName", T.StringType()),
        T.StructField("lastKnownLatitude", T.DoubleType()),
        T.StructField("lastKnownLongitude", T.DoubleType()),
        T.StructField("silenceDurationMs", T.LongType()),
        T.StructField("lastSeenAt", T.TimestampType()),
        T.StructField("alertRaisedAt", T.TimestampType()),
    ]
)

SACCO_REVENUE_WINDOW = T.StructType(
    [
        T.StructField("saccoId", T.StringType()),
        T.StructField("saccoName", T.StringType()),
        T.StructField("totalRevenueKes", T.DecimalType(18, 2)),
        T.StructField("transactionCount", T.LongType()),
        T.StructField("windowStart", T.TimestampType()),
        T.StructField("windowEnd", T.TimestampType()),
    ]
)
