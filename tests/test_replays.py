"""Streams on replayed records: revenue on each operator's own stream time,
event-time off-grid alerts, state read back. (The registered replays are
checked against SQL in ``test_oracle.py``.)"""

from __future__ import annotations

import datetime as dt
import os
import random
from functools import partial

import pandas as pd
from pyspark.sql import functions as F

from fixtures_small import at
from fleetlens.operators import offgrid, revenue
from fleetlens.settings import JobSettings
from fleetlens.streaming import event_offgrid, replay, sinks, state_tables, stream_time

FARE = "transactionId string, matatuId string, amountKes decimal(18,2), status string, timestamp timestamp, arrivalTs timestamp, eventId long"
PING = "matatuId string, routeId string, routeName string, latitude double, longitude double, timestamp timestamp, eventId long"


def run_revenue(spark, fares, per_file=1, settings=JobSettings()):
    """(windows, late fares, checkpoint) of a replay with ``per_file`` fares a
    micro-batch."""
    folder = replay.arrival_files(fares, ["arrivalTs", "eventId"], rows_per_file=per_file, least_files=1)
    flow = stream_time.revenue_flow(replay.record_stream(spark, folder, fares), settings)
    root = replay.new_folder(spark, "t")
    outputs = {"windows": partial(stream_time.closed_windows, settings=settings), "late": partial(stream_time.late_fares, settings=settings)}
    start = partial(sinks.start_outputs, flow, outputs, f"{root}/out", os.path.basename(root), checkpoint=f"{root}/checkpoint")
    replay.run(start, spark, 2)
    return spark.read.parquet(f"{root}/out/windows"), spark.read.parquet(f"{root}/out/late"), f"{root}/checkpoint"


def fare_rows(rows):
    """rows: (vehicle, amount, event minute, arrival minute)."""
    return [
        (f"TXN-{i}", v, amount, "SUCCESS", at(t), at(a), i) for i, (v, amount, t, a) in enumerate(rows)
    ]


def other_operator(settings=JobSettings()):
    """Two vehicles whose fares go to different operators."""
    keys = sorted(k for k, _ in revenue.operator_keys(settings.revenue_key_mode))

    def key(v):
        h = 0
        for c in v:
            h = (h * 31 + ord(c)) & 0x7FFFFFFF
        return keys[h % len(keys)]

    first = "KBZ 1"
    return first, next(f"KBZ {i}" for i in range(2, 50) if key(f"KBZ {i}") != key(first))


def D(x):
    from decimal import Decimal

    return Decimal(x)


def test_late_fare_is_judged_per_record_within_a_micro_batch(spark):
    """10 and 100 are in time; the fare at minute 66 moves the clock past 65;
    the one that arrives after it is late, in the same micro-batch."""
    rows = fare_rows([("KBZ 1", D("10.00"), 10, 10), ("KBZ 1", D("100.00"), 20, 20), ("KBZ 1", D("5.00"), 66, 66), ("KBZ 1", D("1000.00"), 30, 67)])
    fares = spark.createDataFrame(rows, FARE)
    for per_file in (10, 1):
        windows, late, _ = run_revenue(spark, fares, per_file)
        assert [(r.totalRevenueKes, r.transactionCount) for r in windows.collect()] == [(D("110.00"), 2)]
        got = late.collect()
        assert [(r.transactionId, r.amountKes) for r in got] == [("TXN-3", D("1000.00"))]


def test_each_operator_has_its_own_clock(spark):
    """An operator far ahead closes no window of another, and makes none of
    its fares late."""
    a, b = other_operator()
    rows = fare_rows([(a, D("1.00"), 10, 10), (b, D("2.00"), 600, 11), (a, D("3.00"), 20, 12), (b, D("4.00"), 30, 13)])
    windows, late, _ = run_revenue(spark, spark.createDataFrame(rows, FARE))
    assert windows.count() == 0
    assert [r.transactionId for r in late.collect()] == ["TXN-3"]


def test_window_closes_at_end_plus_grace_and_once(spark):
    rows = fare_rows([("KBZ 1", D("1.00"), 10, 10), ("KBZ 1", D("1.00"), 65, 65), ("KBZ 1", D("1.00"), 66, 66), ("KBZ 1", D("9.00"), 59, 70)])
    windows, late, _ = run_revenue(spark, spark.createDataFrame(rows, FARE))
    assert [(r.totalRevenueKes, r.windowEnd) for r in windows.collect()] == [(D("1.00"), at(60))]
    assert [r.transactionId for r in late.collect()] == ["TXN-3"]


def test_random_arrivals_equal_a_row_by_row_simulation(spark):
    rng = random.Random(4)
    s = JobSettings(revenue_window_minutes=10, revenue_grace_minutes=3)
    rows = fare_rows([(f"KBZ {rng.randrange(6)}", D(rng.randrange(1, 900)) / 100, t := rng.randrange(200), max(0, t + rng.choice([0, 0, 1, 5, 14, 40]))) for _ in range(300)])
    fares = spark.createDataFrame(rows, FARE)
    windows, late, checkpoint = run_revenue(spark, fares, 60, s)
    key = {r.matatuId: r.saccoId for r in revenue.assign_operator(fares, s).collect()}
    clock, open_, closed, lost = {}, {}, [], []
    for txn, v, amount, _, t, _, _ in sorted(rows, key=lambda r: (r[5], r[6])):
        k, minute = key[v], (t - at(0)) // dt.timedelta(minutes=1)
        clock[k] = max(clock.get(k, minute), minute)
        start = minute // 10 * 10
        if start + 13 <= clock[k]:
            lost.append(txn)
        else:
            total, n = open_.get((k, start), (D(0), 0))
            open_[k, start] = (total + amount, n + 1)
        for w in [w for w in open_ if w[0] == k and w[1] + 13 <= clock[k]]:
            closed.append((*w, *open_.pop(w)))
    got = [(r.saccoId, (r.windowStart - at(0)) // dt.timedelta(minutes=1), r.totalRevenueKes, r.transactionCount) for r in windows.collect()]
    assert sorted(got) == sorted(closed)
    assert sorted(r.transactionId for r in late.collect()) == sorted(lost) and lost
    still = state_tables.open_windows(spark, checkpoint, settings=s).collect()
    assert {(r.saccoId, (r.windowStart - at(0)) // dt.timedelta(minutes=1)): (r.totalRevenueKes, r.transactionCount) for r in still} == open_
    clocks = {r.saccoId: (r.streamTime - at(0)) // dt.timedelta(minutes=1) for r in state_tables.operator_clocks(spark, checkpoint).collect()}
    assert clocks == clock


def run_offgrid(spark, pings, settings, per_file):
    folder = replay.arrival_files(pings, ["timestamp", "eventId"], rows_per_file=per_file, least_files=1)
    flow = event_offgrid.offgrid_flow(replay.record_stream(spark, folder, pings), settings)
    root = replay.new_folder(spark, "t")
    start = partial(
        sinks.start_outputs, flow, {"alerts": partial(event_offgrid.alerts, settings=settings)}, f"{root}/out",
        os.path.basename(root), checkpoint=f"{root}/checkpoint",
    )
    replay.run(start, spark, 2)
    return spark.read.parquet(f"{root}/out/alerts").drop("batch_id"), f"{root}/checkpoint"


def test_event_time_alerts_equal_the_batch_ticks(spark):
    rng = random.Random(9)
    s = JobSettings(offgrid_silence_ms=300_000, offgrid_check_interval_ms=60_000)
    rows, t = [], 0.0
    for i in range(160):
        t += rng.choice([0.0, 0.3, 1.0, 4.7, 11.0])
        v = rng.choice(["KBZ 1", "KBZ 2", "KBZ 3"])
        rows.append((v, "route_33", "Route 33", float(i), 1.0, at(t) + dt.timedelta(microseconds=rng.randrange(1, 999)), i))
    rows.append(("KBZ 9", "route_1", "Route 1", 0.5, 1.0, at(0), 999))  # pings once, then never again
    pings = spark.createDataFrame(rows, PING)
    want = offgrid.tick_alerts(pings, None, s)
    for per_file in (200, 25):
        got, checkpoint = run_offgrid(spark, pings, s, per_file)
        assert got.count() == want.count() > 100
        assert got.exceptAll(want.select(*got.columns)).count() == 0
    seen = state_tables.last_seen(spark, checkpoint)
    assert seen.exceptAll(offgrid.last_seen(pings).select(*seen.columns)).count() == 0
    assert seen.count() == 4


def test_a_ping_at_the_watermark_still_ends_the_silence(spark):
    """Vehicle 2 moves the watermark to the very tick at which vehicle 1 pings
    in a later micro-batch: the tick is not raised for vehicle 1."""
    s = JobSettings(offgrid_silence_ms=300_000, offgrid_check_interval_ms=60_000)
    rows = [("KBZ 1", "r", "R", 0.0, 0.0, at(0), 0), ("KBZ 2", "r", "R", 0.0, 0.0, at(6), 1), ("KBZ 1", "r", "R", 0.0, 0.0, at(6), 2), ("KBZ 2", "r", "R", 0.0, 0.0, at(7), 3)]
    got, _ = run_offgrid(spark, spark.createDataFrame(rows, PING), s, 1)
    assert got.count() == 0


def test_arrival_files_follow_the_order(spark):
    rows = [(i, at(i % 7)) for i in range(500)]
    df = spark.createDataFrame(rows, "eventId long, timestamp timestamp")
    folder = replay.arrival_files(df, ["timestamp", "eventId"], rows_per_file=100)
    files = sorted((f for f in os.listdir(folder.removeprefix("file:")) if f.startswith("part-")), key=lambda f: os.path.getmtime(os.path.join(folder, f)))
    got = pd.concat([pd.read_json(os.path.join(folder, f), lines=True) for f in files])
    assert len(files) >= 4 and len(got) == 500
    want = sorted(rows, key=lambda r: (r[1], r[0]))
    assert got["eventId"].tolist() == [r[0] for r in want]
    empty = replay.arrival_files(df.limit(0), ["timestamp"])
    query = replay.run(lambda: sinks.start_outputs(replay.record_stream(spark, empty, df), {"x": lambda b: b.agg(F.count("*").alias("n"))}, f"{empty}/out", "none", checkpoint=f"{empty}/cp"), spark)
    assert query.exception() is None


def test_history_is_handed_over_once(spark, scratch):
    """Vehicles known only to the history, only to the stream and to both; a
    restart goes on from the checkpoint, not from the history again."""
    from fleetlens.operators import occupancy
    from fleetlens.streaming import handover

    rng = random.Random(6)
    schema = "matatuId string, routeId string, routeName string, latitude double, longitude double, passengersOnboard int, timestamp timestamp, eventId long"

    def pings(vehicles, lo, hi):
        return [(rng.choice(vehicles), r := rng.choice(["r1", "r2"]), f"Route {r}", 0.0, 0.0, rng.randrange(30), at(t), t) for t in range(lo, hi)]

    old = pings(["A", "B"], 0, 60)
    new = pings(["B", "C"], 60, 120)
    history, later = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    folder = replay.arrival_files(later, ["timestamp", "eventId"], rows_per_file=15)
    files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    aside = os.path.join(scratch, "aside")
    os.makedirs(aside)
    for f in files[2:]:
        os.replace(os.path.join(folder, f), os.path.join(aside, f))
    root = replay.new_folder(spark, "t")

    def run():
        flow = handover.occupancy_flow(replay.record_stream(spark, folder, later), history)
        outputs = {"log": lambda b: b.drop("lastUpdated")}
        start = partial(sinks.start_outputs, flow, outputs, f"{root}/out", os.path.basename(root), checkpoint=f"{root}/checkpoint")
        replay.run(start, spark, 2)

    run()
    for f in files[2:]:
        os.replace(os.path.join(aside, f), os.path.join(folder, f))
    run()
    got = spark.read.parquet(f"{root}/out/log")
    whole = occupancy.occupancy_changelog(occupancy.passenger_deltas(spark.createDataFrame(old + new, schema))).filter("eventId >= 60")
    cols = ["routeId", "currentPassengers", "totalBoardings", "totalAlightings", "eventId"]
    assert got.count() == whole.count() == 60
    assert got.select(cols).exceptAll(whole.select(cols)).count() == 0
