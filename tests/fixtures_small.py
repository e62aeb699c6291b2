"""Builders for small hand-written location and fare frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOC_SCHEMA = T.StructType(
    [
        T.StructField("matatuId", T.StringType()),
        T.StructField("routeId", T.StringType()),
        T.StructField("routeName", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("speedKmh", T.DoubleType()),
        T.StructField("passengersOnboard", T.IntegerType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("eventId", T.LongType()),
    ]
)

FARE_SCHEMA = T.StructType(
    [
        T.StructField("transactionId", T.StringType()),
        T.StructField("matatuId", T.StringType()),
        T.StructField("passengerId", T.StringType()),
        T.StructField("amountKes", T.DecimalType(18, 2)),
        T.StructField("paymentMethod", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("eventId", T.LongType()),
        T.StructField("arrivalTs", T.TimestampNTZType()),
    ]
)

T0 = dt.datetime(2024, 1, 1, 9, 0, 0)


def at(minutes: float = 0, ms: int = 0) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minutes, milliseconds=ms)


def pings(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows: (matatuId, routeId, speed, passengers, timestamp)."""
    out = []
    for i, (m, r, speed, pax, ts) in enumerate(rows):
        name = "Route " + r.split("_")[-1] if r else None
        out.append((m, r, name, -1.29, 36.82, float(speed), pax, ts, i))
    return spark.createDataFrame(out, LOC_SCHEMA)


def fares(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows: (matatuId, amount, status, timestamp[, arrival])."""
    out = []
    for i, row in enumerate(rows):
        m, amount, status, ts = row[:4]
        arrival = row[4] if len(row) > 4 else ts
        out.append((f"TXN-{i}", m, f"PAX-{i}", Decimal(amount), "MPESA", status, ts, i, arrival))
    return spark.createDataFrame(out, FARE_SCHEMA)
