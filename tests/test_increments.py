"""Occupancy extended part by part against a fold over everything."""

from __future__ import annotations

import os
import random

from fixtures_small import at
from fleetlens.operators import occupancy
from fleetlens.operators.increments import OccupancyParts

PING = (
    "matatuId string, routeId string, routeName string, latitude double, longitude double, "
    "passengersOnboard int, timestamp timestamp, eventId long"
)


def pings(rng, lo, hi, vehicles):
    return [
        (rng.choice(vehicles), r := rng.choice(["r1", "r2", "r3"]), f"Route {r} {t // 50}", 0.0, 0.0, rng.randrange(33), at(t), t)
        for t in range(lo, hi)
    ]


def whole(spark, rows):
    df = spark.createDataFrame(rows, PING)
    return sorted(map(tuple, occupancy.route_occupancy(occupancy.passenger_deltas(df)).collect()))


def test_parts_equal_one_fold(spark, scratch, run_id):
    rng = random.Random(3)
    days = [pings(rng, 0, 90, "AB"), pings(rng, 90, 150, "BC"), [], pings(rng, 150, 260, "ACD")]
    parts = OccupancyParts(spark, os.path.join(scratch, run_id))
    seen = []
    for i, day in enumerate(days):
        seen += day
        parts.extend(i, spark.createDataFrame(day, PING))
        assert sorted(map(tuple, parts.occupancy().collect())) == whole(spark, seen)
    assert parts.parts() == [0, 1, 2, 3]


def test_adding_a_part_reads_no_earlier_pings(spark, scratch, run_id):
    rng = random.Random(4)
    base = os.path.join(scratch, run_id)
    for i, (lo, hi) in enumerate([(0, 60), (60, 120)]):
        spark.createDataFrame(pings(rng, lo, hi, "ABC"), PING).write.parquet(f"{base}/in/day={i}")
    parts = OccupancyParts(spark, f"{base}/parts")
    first, second = (spark.read.parquet(f"{base}/in/day={i}") for i in range(2))
    parts.extend(0, first)
    for f in os.listdir(f"{base}/in/day=0"):  # gone: a second read would fail
        os.replace(f"{base}/in/day=0/{f}", f"{base}/{f}.away")
    parts.extend(1, second)
    assert parts.occupancy().count() == 3
    reads = parts.occupancy()._jdf.queryExecution().executedPlan().toString()
    assert f"{run_id}/in" not in reads and "parts/routes" in reads


def test_a_part_extended_again_drops_the_later_ones(spark, scratch, run_id):
    rng = random.Random(5)
    a, b, extra = pings(rng, 0, 50, "AB"), pings(rng, 60, 100, "AB"), pings(rng, 50, 60, "AB")
    parts = OccupancyParts(spark, os.path.join(scratch, run_id))
    parts.extend(0, spark.createDataFrame(a, PING))
    parts.extend(1, spark.createDataFrame(b, PING))
    parts.extend(0, spark.createDataFrame(a + extra, PING))
    assert parts.parts() == [0]
    parts.extend(1, spark.createDataFrame(b, PING))
    assert sorted(map(tuple, parts.occupancy().collect())) == whole(spark, a + extra + b)
