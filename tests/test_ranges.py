"""Ordered scans cut by rows: a burst within one minute is spread over ranges
and every scan gives the same rows as with chunks of time."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures_small import at
from fleetlens.operators import occupancy, offgrid, revenue, scan
from fleetlens.settings import JobSettings

PING = (
    "matatuId string, routeId string, routeName string, latitude double, longitude double, "
    "passengersOnboard int, timestamp timestamp, eventId long"
)
FARE = "transactionId string, matatuId string, amountKes decimal(18,2), status string, timestamp timestamp, arrivalTs timestamp, eventId long"
RANGED = JobSettings(scan_rows_per_range=25)


def burst(n=400):
    """All pings within one minute, most of one vehicle, many at one instant."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        v = "KBZ 1" if i % 10 else f"KBZ {rng.randrange(2, 5)}"
        r = rng.choice(["route_33", "route_23"])
        rows.append((v, r, f"Name {i}", 1.0, 2.0, rng.randrange(30), at(0) + dt.timedelta(milliseconds=rng.randrange(40)), i))
    return rows


def same(a, b):
    assert a.count() == b.count() > 0
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_a_burst_of_one_key_is_spread(spark):
    pings = spark.createDataFrame(burst(), PING)
    cut = scan.with_ranges(pings, "matatuId", ["timestamp", "eventId"], 25)
    own = cut.filter("matatuId = 'KBZ 1'").groupBy(scan.CHUNK).count().collect()
    assert len(own) >= 10 and max(r["count"] for r in own) <= 100
    # the chunk grows with the order of a key's rows
    rows = [r for r in cut.select("matatuId", "timestamp", "eventId", scan.CHUNK).collect()]
    rows.sort(key=lambda r: (r.matatuId, r.timestamp, r.eventId))
    assert all(a[scan.CHUNK] <= b[scan.CHUNK] for a, b in zip(rows, rows[1:]))
    by_time = scan.with_chunk(pings, "matatuId", "timestamp", 60)
    assert by_time.filter("matatuId = 'KBZ 1'").select(scan.CHUNK).distinct().count() == 1


def test_deltas_and_occupancy_are_the_same(spark):
    pings = spark.createDataFrame(burst(), PING)
    by_time, ranged = occupancy.passenger_deltas(pings), occupancy.passenger_deltas(pings, RANGED)
    same(ranged, by_time)
    same(occupancy.occupancy_changelog(ranged, RANGED), occupancy.occupancy_changelog(by_time))
    same(occupancy.route_occupancy(ranged, RANGED), occupancy.route_occupancy(by_time))


def test_silence_gaps_are_the_same(spark):
    s = JobSettings(offgrid_silence_ms=2, offgrid_check_interval_ms=1)
    pings = spark.createDataFrame(burst(), PING)
    same(offgrid.tick_alerts(pings, None, s.with_(scan_rows_per_range=25)), offgrid.tick_alerts(pings, None, s))


@pytest.mark.parametrize("rows_per_range", [1, 40, 10**6])
def test_late_fares_are_the_same(spark, rows_per_range):
    rng = random.Random(8)
    rows = [
        (f"TXN-{i}", f"KBZ {rng.randrange(3)}", Decimal(rng.randrange(1, 99)), "SUCCESS", at(rng.randrange(400)), at(0) + dt.timedelta(milliseconds=rng.randrange(30)), i)
        for i in range(120)
    ]
    fares = spark.createDataFrame(rows, FARE)
    s = RANGED.with_(scan_rows_per_range=rows_per_range)
    same(revenue.late_fares(fares, s), revenue.late_fares(fares))
    same(revenue.emitted_revenue(fares, s), revenue.emitted_revenue(fares))


def test_empty_input(spark):
    pings = spark.createDataFrame([], PING)
    assert occupancy.passenger_deltas(pings, RANGED).count() == 0
    assert scan.with_ranges(pings, "matatuId", ["timestamp"], 5).filter(F.col(scan.CHUNK).isNotNull()).count() == 0
