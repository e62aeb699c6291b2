"""Structured Streaming tests: numbered JSON files, one micro-batch each."""

from __future__ import annotations

import datetime as dt
import glob
import os
import time
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from fixtures_small import at
from fleetlens.operators import occupancy, revenue, routing, stateless
from fleetlens.settings import JobSettings
from fleetlens.sources.codec import LOCATION_FIELDS
from fleetlens.sources.fixtures import load_fares, load_locations
from fleetlens.streaming import jobs, sinks, sources
from streamkit import fare_files, location_files, split_frames, write_batches


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def test_occupancy_stream_equals_batch(spark, scratch, run_id):
    folder = os.path.join(scratch, run_id, "loc")
    write_batches(folder, split_frames(load_locations(spark, SMALL).toPandas(), 4))
    stream = location_files(spark, folder)
    _run(sinks.start(jobs.occupancy_flow(jobs.delta_flow(stream)), f"occ_{run_id}", fmt="memory"))
    got = spark.table(f"occ_{run_id}")
    batch = occupancy.occupancy_changelog(occupancy.passenger_deltas(load_locations(spark, SMALL)))
    cols = ["routeId", "currentPassengers", "totalBoardings", "totalAlightings", "eventId"]
    assert got.count() == batch.count() == 599
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0


@pytest.mark.parametrize("split", [False, True])
def test_occupancy_stream_coalesces_per_batch(spark, scratch, run_id, split):
    folder = os.path.join(scratch, run_id, "loc")
    write_batches(folder, split_frames(load_locations(spark, SMALL).toPandas(), 3))
    stream = location_files(spark, folder)
    flow = jobs.occupancy_flow(jobs.delta_flow(stream), every_update=False, split_routes=split)
    _run(sinks.start(flow, f"occ1_{run_id}_{int(split)}", fmt="memory"))
    got = spark.table(f"occ1_{run_id}_{int(split)}")
    final = occupancy.route_occupancy(occupancy.passenger_deltas(load_locations(spark, SMALL)))
    last = got.groupBy("routeId").agg(F.max_by("currentPassengers", "eventId").alias("c"))
    want = {r.routeId: r.currentPassengers for r in final.collect()}
    assert {r.routeId: r.c for r in last.collect()} == want
    assert got.count() <= 3 * len(want)
    assert got.filter(F.col("lastUpdated") < F.lit(dt.datetime(2025, 1, 1))).count() == 0
    # each coalesced row equals the full changelog at that route's last delta
    # of the micro-batch (chunk summaries composed in order)
    log = occupancy.occupancy_changelog(occupancy.passenger_deltas(load_locations(spark, SMALL)))
    cols = ["routeId", "eventId", "currentPassengers", "totalBoardings", "totalAlightings"]
    assert got.select(cols).exceptAll(log.select(cols)).count() == 0


def _fare_frame(rows):
    out = []
    for i, (amount, ts) in enumerate(rows):
        out.append(
            {
                "transactionId": f"TXN-{i}",
                "matatuId": "KBZ 1",
                "passengerId": "PAX-1",
                "amountKes": float(amount),
                "paymentMethod": "MPESA",
                "status": "SUCCESS",
                "timestamp": pd.Timestamp(ts),
                "eventId": i,
            }
        )
    return pd.DataFrame(out)


def test_revenue_stream_drops_fares_for_closed_windows(spark, scratch, run_id):
    folder = os.path.join(scratch, run_id, "fares")
    batches = [
        _fare_frame([("10.00", at(10)), ("100.00", at(20))]),
        _fare_frame([("5.00", at(66))]),  # event time passes 10:05: [09:00, 10:00) closes
        _fare_frame([("1000.00", at(30))]),  # late for the closed window
    ]
    write_batches(folder, batches)
    stream = fare_files(spark, folder)
    _run(jobs.start_revenue(stream, f"rev_{run_id}", fmt="memory"))
    rows = spark.table(f"rev_{run_id}").collect()
    assert [(r.totalRevenueKes, r.transactionCount) for r in rows] == [(Decimal("110.00"), 2)]
    assert rows[0].windowEnd - rows[0].windowStart == dt.timedelta(hours=1)


def test_revenue_stream_matches_batch_closed_windows(spark, scratch, run_id):
    folder = os.path.join(scratch, run_id, "fares")
    fares_pdf = load_fares(spark, SMALL).toPandas().drop(columns=["arrivalTs"])
    write_batches(folder, split_frames(fares_pdf, 4))
    stream = fare_files(spark, folder)
    _run(jobs.start_revenue(stream, f"revall_{run_id}", fmt="memory"))
    got = spark.table(f"revall_{run_id}").select(
        "saccoId", "totalRevenueKes", "transactionCount", F.col("windowStart").cast("timestamp_ntz").alias("w")
    )
    batch = revenue.windowed_revenue(load_fares(spark, SMALL))
    max_ts = load_fares(spark, SMALL).agg(F.max("timestamp")).first()[0]
    closed = batch.filter(F.col("windowEnd") + F.expr("INTERVAL 5 MINUTES") <= F.lit(max_ts)).select(
        "saccoId", "totalRevenueKes", "transactionCount", F.col("windowStart").alias("w")
    )
    assert got.count() == closed.count() > 0
    assert got.exceptAll(closed).count() == 0


def test_offgrid_alerts_repeat_on_processing_time_ticks(spark, scratch, run_id):
    folder = os.path.join(scratch, run_id, "loc")
    pdf = load_locations(spark, SMALL).toPandas()
    pdf = pdf[pdf["matatuId"].isin(["KBZ 1", "KBZ 2"])].head(6)
    write_batches(folder, [pdf])
    s = JobSettings(offgrid_silence_ms=1_000, offgrid_check_interval_ms=500)
    stream = location_files(spark, folder)
    q = sinks.start(
        jobs.offgrid_flow(stream, s), f"off_{run_id}", fmt="memory", trigger={"processingTime": "250 milliseconds"}
    )
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            time.sleep(1)
            if spark.table(f"off_{run_id}").count() >= 6:
                break
    finally:
        q.stop()
    rows = spark.table(f"off_{run_id}").collect()
    by_vehicle: dict[str, list] = {}
    for r in rows:
        by_vehicle.setdefault(r.matatuId, []).append(r)
    assert set(by_vehicle) == set(pdf["matatuId"])
    for alerts in by_vehicle.values():
        assert all(a.silenceDurationMs > 1_000 for a in alerts)
        ticks = sorted(a.alertRaisedAt for a in alerts)
        assert all((t - dt.datetime(1970, 1, 1)) % dt.timedelta(milliseconds=500) == dt.timedelta(0) for t in ticks)
        # at most one alert per tick while silent
        assert all(b - a >= dt.timedelta(milliseconds=500) for a, b in zip(ticks, ticks[1:]))
        seen = {a.lastSeenAt for a in alerts}
        assert len(seen) == 1 and all(a.silenceDurationMs == (a.alertRaisedAt - a.lastSeenAt) // dt.timedelta(milliseconds=1) for a in alerts)
    assert max(len(a) for a in by_vehicle.values()) >= 2


def test_stateless_flows_and_sinks(spark, scratch, run_id):
    base = os.path.join(scratch, run_id)
    locs_pdf = load_locations(spark, SMALL).toPandas()
    fares_pdf = load_fares(spark, SMALL).toPandas().drop(columns=["arrivalTs"])
    write_batches(os.path.join(base, "loc"), split_frames(locs_pdf, 3))
    write_batches(os.path.join(base, "fares"), split_frames(fares_pdf, 3))
    loc_stream = location_files(spark, os.path.join(base, "loc"))
    fare_stream = fare_files(spark, os.path.join(base, "fares"))
    out = os.path.join(base, "out")
    queries = jobs.start_all(loc_stream, fare_stream, out, name_prefix=f"{run_id}_")
    for q in queries.values():
        _run(q)
    # checkpoints are per query, under the shared checkpoint folder
    assert len({q.name for q in queries.values()}) == len(queries)
    alerts = spark.read.json(os.path.join(out, "speed_alerts"))
    assert alerts.count() == stateless.speed_alerts(load_locations(spark, SMALL)).count() == 118
    failed = spark.read.json(os.path.join(out, "fares_failed"))
    assert failed.count() == routing.failed_fares(load_fares(spark, SMALL)).count() == 43
    assert set(failed.columns) == {"key", "value", "batch_id"}
    enriched = spark.read.json(os.path.join(out, "location_enriched"))
    assert enriched.count() == 599
    board = spark.read.json(os.path.join(out, "display_board"))
    assert board.count() == 599 and {"offset", "key"} <= set(board.columns) and "partition" not in board.columns
    fare_lines = spark.read.json(os.path.join(out, "fare_log"))
    assert fare_lines.count() == 401 and fare_lines.filter(F.col("message").startswith("[FARES] ")).count() == 401
    assert glob.glob(os.path.join(out, "location_audit", "batch_id=*", "eventDate=*"))
    assert spark.read.json(os.path.join(out, "sacco_revenue")).count() > 0
    # one read an input for all narrow flows
    assert {len(q.lastProgress["sources"]) for q in queries.values()} == {1} and len(queries) == 4


def test_independent_readers_keep_their_own_progress(spark, scratch, run_id):
    """Two readers of one source: each has its own checkpoint and sees every
    record; a reader started later still starts from the earliest file."""
    folder = os.path.join(scratch, run_id, "loc")
    frames = split_frames(load_locations(spark, SMALL).toPandas(), 2)
    write_batches(folder, frames[:1])
    first = sinks.start(location_files(spark, folder), f"board_{run_id}", fmt="memory")
    _run(first)
    write_batches(folder + "_more", frames[1:])
    import shutil

    for f in glob.glob(os.path.join(folder + "_more", "*.json")):
        shutil.copy(f, os.path.join(folder, "00001.json"))
    logger = sinks.start(location_files(spark, folder), f"logger_{run_id}", fmt="memory")
    _run(logger)
    assert spark.table(f"logger_{run_id}").count() == 599
    assert spark.table(f"board_{run_id}").count() == len(frames[0])


def test_branch_counters_are_observed(spark):
    from pyspark.sql import Observation

    obs = Observation("branches")
    df = load_fares(spark, SMALL).observe(
        obs,
        *[F.sum(F.when(F.col("status") == s, 1).otherwise(0)).alias(s) for s in ("FAILED", "SUCCESS", "PENDING")],
    )
    df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"FAILED": 43, "SUCCESS": 319, "PENDING": 39}
    observed = routing.observe_branches(load_fares(spark, SMALL))
    assert observed.count() == 401


def test_keyed_batch_publish(spark, scratch, run_id):
    out = os.path.join(scratch, run_id, "pub")
    sinks.write_keyed(load_locations(spark, SMALL), "routeId", LOCATION_FIELDS, out)
    back = spark.read.json(out)
    assert back.count() == 599
    assert set(back.columns) == {"key", "value"}
    assert back.filter(F.col("key") == "route_99").count() == 98


def test_branch_sink_writes_each_branch_once_per_batch(spark, scratch, run_id):
    base = os.path.join(scratch, run_id)
    fares_pdf = load_fares(spark, SMALL).toPandas().drop(columns=["arrivalTs"])
    write_batches(os.path.join(base, "fares"), split_frames(fares_pdf, 2))
    stream = fare_files(spark, os.path.join(base, "fares"))
    paths = {b: os.path.join(base, b) for b in ("failed", "success", "default")}
    _run(sinks.start_branches(jobs.fare_branch_flow(stream), "branch", paths, f"br_{run_id}"))
    counts = {b: spark.read.json(p).count() for b, p in paths.items()}
    assert counts == {"failed": 43, "success": 319, "default": 39}
    assert len(glob.glob(os.path.join(paths["failed"], "batch_id=*"))) == 2


def test_command_line_runs_all_flows_once(spark, scratch, run_id):
    from fleetlens.__main__ import main

    base = os.path.join(scratch, run_id)
    write_batches(os.path.join(base, "loc"), split_frames(load_locations(spark, SMALL).toPandas(), 2))
    fares_pdf = load_fares(spark, SMALL).toPandas().drop(columns=["arrivalTs"])
    write_batches(os.path.join(base, "fares"), split_frames(fares_pdf, 2))
    main(
        [
            "--locations", os.path.join(base, "loc"),
            "--fares", os.path.join(base, "fares"),
            "--out", os.path.join(base, "out"),
            "--name-prefix", f"{run_id}_",
            "--once", "--max-files-per-trigger", "1", "--state-partitions", "4",
            "--profile", "local",
        ]
    )
    assert spark.read.json(os.path.join(base, "out", "speed_alerts")).count() == 118
    occ = spark.read.json(os.path.join(base, "out", "route_occupancy"))
    assert 6 <= occ.count() <= 12  # one row per changed route per micro-batch
    parsed = occ.select(F.from_json("value", "routeId string, currentPassengers int, lastUpdated timestamp").alias("v"))
    last = parsed.groupBy("v.routeId").agg(F.max_by("v.currentPassengers", "v.lastUpdated").alias("c"))
    final = occupancy.route_occupancy(occupancy.passenger_deltas(load_locations(spark, SMALL)))
    assert {r.routeId: r.c for r in last.collect()} == {r.routeId: r.currentPassengers for r in final.collect()}


def test_streams_accept_records_without_event_id(spark, scratch, run_id):
    """Plain LocationEvent JSON (no offset field): order falls back to time."""
    folder = os.path.join(scratch, run_id, "loc")
    pdf = load_locations(spark, SMALL).toPandas().drop(columns=["eventId"])
    write_batches(folder, split_frames(pdf, 2, order=("timestamp",)))
    stream = location_files(spark, folder)
    _run(sinks.start(jobs.occupancy_flow(jobs.delta_flow(stream)), f"noid_{run_id}", fmt="memory"))
    got = spark.table(f"noid_{run_id}")
    assert got.count() == 599
    assert got.filter(F.col("eventId").isNotNull()).count() == 0
    final = {r.routeId: r.currentPassengers for r in occupancy.route_occupancy(
        occupancy.passenger_deltas(load_locations(spark, SMALL))).collect()}
    last = got.groupBy("routeId").agg(F.max_by("currentPassengers", "timestamp").alias("c")).collect()
    assert {r.routeId: r.c for r in last} == final


def test_offgrid_new_ping_ends_the_silence(spark, scratch, run_id):
    folder = os.path.join(scratch, run_id, "loc")
    pdf = load_locations(spark, SMALL).toPandas()
    one = pdf[pdf["matatuId"] == "KBZ 1"].head(1)
    write_batches(folder, [one])
    s = JobSettings(offgrid_silence_ms=1_000, offgrid_check_interval_ms=500)
    stream = location_files(spark, folder)
    name = f"off2_{run_id}"
    q = sinks.start(jobs.offgrid_flow(stream, s), name, fmt="memory", trigger={"processingTime": "250 milliseconds"})
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table(name).count() < 2:
            time.sleep(0.5)
        # a new ping: written under a dot name, renamed, newer modification time
        tmp, final = os.path.join(folder, ".00001.json.tmp"), os.path.join(folder, "00001.json")
        with open(os.path.join(folder, "00000.json")) as src, open(tmp, "w") as dst:
            dst.write(src.read())
        os.replace(tmp, final)
        deadline = time.time() + 60
        while time.time() < deadline and spark.table(name).select("lastSeenAt").distinct().count() < 2:
            time.sleep(0.5)
    finally:
        q.stop()
    rows = spark.table(name).collect()
    seen = sorted({r.lastSeenAt for r in rows})
    assert len(seen) == 2, "alerting resumed after the new ping went silent too"
    old, new = seen
    # no alert for the old silence after the new ping was seen
    assert all(r.alertRaisedAt <= new for r in rows if r.lastSeenAt == old)
    assert all(r.silenceDurationMs > 1_000 for r in rows)


def test_offgrid_state_ttl_ends_the_alerts(spark, scratch, run_id):
    folder = os.path.join(scratch, run_id, "loc")
    pdf = load_locations(spark, SMALL).toPandas()
    write_batches(folder, [pdf[pdf["matatuId"] == "KBZ 2"].head(1)])
    s = JobSettings(offgrid_silence_ms=500, offgrid_check_interval_ms=250)
    stream = location_files(spark, folder)
    name = f"ttl_{run_id}"
    q = sinks.start(
        jobs.offgrid_flow(stream, s, ttl_ms=15_000), name, fmt="memory", trigger={"processingTime": "200 milliseconds"}
    )
    try:
        # the first micro-batch starts Python workers; on a busy machine that takes seconds
        deadline = time.time() + 60
        while time.time() < deadline and spark.table(name).count() < 1:
            time.sleep(0.5)
        time.sleep(20)  # longer than the state lives
        first = spark.table(name).count()
        time.sleep(4)
        second = spark.table(name).count()
    finally:
        q.stop()
    assert first >= 1  # alerted while the state lived
    assert second == first  # then the state expired and the ticks stopped


def test_late_ping_across_batches_is_folded_in_arrival_order(spark, scratch, run_id):
    """Within a micro-batch pings are ordered by time; a ping that arrives in
    a later micro-batch with an older timestamp is folded when it arrives."""
    def ping(eid, minute, pax):
        return {
            "matatuId": "A", "routeId": "r1", "routeName": "Route 1", "latitude": -1.29,
            "longitude": 36.82, "speedKmh": 10.0, "passengersOnboard": pax,
            "timestamp": pd.Timestamp("2024-01-01 10:00") + pd.Timedelta(minutes=minute), "eventId": eid,
        }

    folder = os.path.join(scratch, run_id, "loc")
    write_batches(folder, [pd.DataFrame([ping(1, 2, 8), ping(0, 0, 5)]), pd.DataFrame([ping(2, 1, 3)])])
    stream = location_files(spark, folder)
    _run(sinks.start(jobs.occupancy_flow(jobs.delta_flow(stream)), f"late_{run_id}", fmt="memory"))
    rows = spark.table(f"late_{run_id}").orderBy("lastUpdated", "timestamp").collect()
    # batch 0 in time order: 5 (delta 5), 8 (delta 3); batch 1: 3 (delta -5)
    assert [(r.eventId, r.currentPassengers, r.totalBoardings, r.totalAlightings) for r in rows] == [
        (0, 5, 5, 0),
        (1, 8, 8, 0),
        (2, 3, 8, 5),
    ]


def test_kafka_records_decode_with_metadata(spark):
    """The Kafka source's decoding, on rows shaped like the connector's."""
    from fleetlens.schemas import LOCATION_EVENT
    locs = load_locations(spark, SMALL)
    keyed = sinks.keyed_records(locs.select(*LOCATION_FIELDS, "eventId"), "routeId", LOCATION_FIELDS)
    raw = keyed.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    decoded = sources.decode_kafka_records(raw, LOCATION_EVENT)
    valid, bad = jobs.validated(decoded, "location")
    assert valid.count() == 599 and bad.count() == 0
    board = jobs.display_board_flow(valid)
    assert board.filter(F.col("key") != F.col("routeId")).count() == 0
    assert board.select("offset").distinct().count() == 599


def test_revenue_stream_dedupes_redelivered_fares(spark, scratch, run_id):
    folder = os.path.join(scratch, run_id, "fares")
    first = _fare_frame([("10.00", at(10)), ("100.00", at(20))])
    again = first.iloc[[1]]  # the same transaction delivered twice
    closer = _fare_frame([("5.00", at(66))]).assign(transactionId="TXN-9", eventId=9)
    write_batches(folder, [first, again, closer])
    stream = fare_files(spark, folder)
    for dedupe, want in [(True, (Decimal("110.00"), 2)), (False, (Decimal("210.00"), 3))]:
        name = f"dd_{run_id}_{int(dedupe)}"
        _run(jobs.start_revenue(stream, name, dedupe=dedupe, fmt="memory"))
        rows = spark.table(name).collect()
        assert [(r.totalRevenueKes, r.transactionCount) for r in rows] == [want]


def test_start_all_live_includes_offgrid_alerts(spark, scratch, run_id):
    base = os.path.join(scratch, run_id)
    pdf = load_locations(spark, SMALL).toPandas()
    write_batches(os.path.join(base, "loc"), [pdf[pdf["matatuId"].isin(["KBZ 1", "KBZ 2"])]])
    fares_pdf = load_fares(spark, SMALL).toPandas().drop(columns=["arrivalTs"]).head(20)
    write_batches(os.path.join(base, "fares"), [fares_pdf])
    s = JobSettings(offgrid_silence_ms=1_000, offgrid_check_interval_ms=500)
    out = os.path.join(base, "out")
    queries = jobs.start_all(
        location_files(spark, os.path.join(base, "loc")),
        fare_files(spark, os.path.join(base, "fares")),
        out,
        s,
        trigger={"processingTime": "500 milliseconds"},
        name_prefix=f"{run_id}_",
    )
    def lines_written() -> int:
        n = 0
        for f in glob.glob(os.path.join(out, "offgrid_alerts", "*.json")):
            with open(f) as fh:
                n += sum(1 for line in fh if line.strip())
        return n

    try:
        assert "offgrid_alerts" in queries
        deadline = time.time() + 90
        while time.time() < deadline and lines_written() < 2:
            time.sleep(1)
    finally:
        for q in queries.values():
            q.stop()
    alerts = spark.read.json(os.path.join(out, "offgrid_alerts"))
    parsed = alerts.select(F.from_json("value", "matatuId string, silenceDurationMs long").alias("v"))
    assert parsed.filter(F.col("v.silenceDurationMs") > 1_000).count() == parsed.count() >= 2
    assert {r.key for r in alerts.select("key").distinct().collect()} <= {"KBZ 1", "KBZ 2"}


def test_restart_resumes_from_checkpoint_with_state(spark, scratch, run_id):
    """Stop after two files, add a third, restart under the same name: each
    file is processed once and the deltas continue from the saved state."""
    base = os.path.join(scratch, run_id)
    frames = split_frames(load_locations(spark, SMALL).toPandas(), 3)
    write_batches(os.path.join(base, "loc"), frames[:2])
    out = os.path.join(base, "out")

    def run():
        stream = location_files(spark, os.path.join(base, "loc"))
        flow = jobs.occupancy_flow(jobs.delta_flow(stream))
        _run(sinks.start(flow, f"restart_{run_id}", fmt="parquet", path=out))

    run()
    first = spark.read.parquet(out).count()
    # the third file arrives while the query is down
    extra = os.path.join(base, "extra")
    write_batches(extra, frames[2:])
    os.replace(os.path.join(extra, "00000.json"), os.path.join(base, "loc", "00002.json"))
    run()
    got = spark.read.parquet(out)
    assert first < got.count() == 599
    log = occupancy.occupancy_changelog(occupancy.passenger_deltas(load_locations(spark, SMALL)))
    cols = ["routeId", "eventId", "currentPassengers", "totalBoardings", "totalAlightings"]
    assert got.select(cols).exceptAll(log.select(cols)).count() == 0


def test_revenue_stream_sacco_key_mode(spark, scratch, run_id):
    folder = os.path.join(scratch, run_id, "fares")
    write_batches(folder, [_fare_frame([("10.00", at(10)), ("100.00", at(20))]), _fare_frame([("5.00", at(66))])])
    stream = fare_files(spark, folder)
    s = JobSettings(revenue_key_mode="sacco")
    _run(jobs.start_revenue(stream, f"sacco_{run_id}", s, fmt="memory"))
    rows = spark.table(f"sacco_{run_id}").collect()
    assert len(rows) == 1 and rows[0].saccoId.startswith("sacco_0")
    names = {"sacco_01": "Citi Hoppa", "sacco_02": "KBS", "sacco_03": "Double M",
             "sacco_04": "Metro Trans", "sacco_05": "Forward Travellers"}
    assert rows[0].saccoName == names[rows[0].saccoId]
    assert (rows[0].totalRevenueKes, rows[0].transactionCount) == (Decimal("110.00"), 2)


@pytest.mark.parametrize("closer, emitted", [(at(64, ms=59_999), False), (at(65), True)])
def test_revenue_stream_window_closes_at_end_plus_grace(spark, scratch, run_id, closer, emitted):
    folder = os.path.join(scratch, run_id, "fares")
    later = _fare_frame([("1.00", closer)]).assign(transactionId="TXN-9", eventId=9)
    write_batches(folder, [_fare_frame([("10.00", at(10))]), later])
    name = f"close_{run_id}_{int(emitted)}"
    _run(jobs.start_revenue(fare_files(spark, folder), name, fmt="memory"))
    starts = [r.windowStart for r in spark.table(name).collect()]
    assert (dt.datetime(2024, 1, 1, 9, 0) in starts) == emitted


def test_stream_quarantines_invalid_records_and_continues(spark, scratch, run_id):
    folder = os.path.join(scratch, run_id, "loc")
    os.makedirs(folder)
    good = '{"matatuId":"A","routeId":"route_33","routeName":"Route 33","latitude":-1.2,"longitude":36.8,' \
           '"speedKmh":90.5,"passengersOnboard":3,"timestamp":"2024-01-01T09:00:00Z","eventId":1}'
    blank = good.replace('"A"', '" "').replace('"eventId":1', '"eventId":2')
    negative = good.replace("90.5", "-1.0").replace('"eventId":1', '"eventId":3')
    with open(os.path.join(folder, ".00000.json.tmp"), "w") as fh:
        fh.write("\n".join([good, blank, negative, "this is not json"]) + "\n")
    os.replace(os.path.join(folder, ".00000.json.tmp"), os.path.join(folder, "00000.json"))
    valid, bad = jobs.validated(location_files(spark, folder), "location")
    _run(sinks.start(jobs.speed_alert_flow(valid), f"ok_{run_id}", fmt="memory"))
    _run(sinks.start(bad, f"bad_{run_id}", fmt="memory"))
    assert [r.eventId for r in spark.table(f"ok_{run_id}").collect()] == [1]
    reasons = sorted(r.invalidReason for r in spark.table(f"bad_{run_id}").collect())
    from fleetlens.sources import codec

    assert reasons == sorted([codec.REASON_BLANK_MATATU, codec.REASON_NEGATIVE_SPEED, codec.REASON_MALFORMED])


def test_published_records_hold_only_their_fields(spark):
    """On file and on Kafka-shaped input: no offset, partition or event id."""
    from fleetlens.schemas import FARE_EVENT, LOCATION_EVENT
    from fleetlens.sources.codec import FARE_FIELDS

    locs, fares = load_locations(spark, SMALL), load_fares(spark, SMALL)
    raw = sinks.keyed_records(locs, "routeId", LOCATION_FIELDS).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    from_kafka, _ = jobs.validated(sources.decode_kafka_records(raw, LOCATION_EVENT), "location")
    for records, fields in [
        (sinks.keyed_records(jobs.speed_alert_flow(locs), "routeId", LOCATION_FIELDS), LOCATION_EVENT.fieldNames()),
        (sinks.keyed_records(jobs.speed_alert_flow(from_kafka), "routeId", LOCATION_FIELDS), LOCATION_EVENT.fieldNames()),
        (sinks.keyed_records(jobs.enrichment_flow(from_kafka), "routeId", jobs.ENRICHED_FIELDS), jobs.ENRICHED_FIELDS),
        (sinks.keyed_records(routing.failed_fares(fares), "matatuId", FARE_FIELDS), FARE_EVENT.fieldNames()),
    ]:
        names = records.select(F.json_object_keys("value").alias("k")).distinct().collect()
        assert [r.k for r in names] == [fields]


def test_keyed_outputs_go_to_their_topics_with_kafka():
    sink = jobs.keyed_sink("speed_alerts", "/out", "json", "host:9092")
    assert sink["fmt"] == "kafka" and sink["options"]["topic"] == sources.OUTPUT_TOPICS["speed_alerts"]
    assert jobs.keyed_sink("speed_alerts", "/out", "json", None) == {"fmt": "json", "path": "/out/speed_alerts"}


def test_kafka_input_needs_a_bound(capsys):
    from fleetlens.__main__ import main

    with pytest.raises(SystemExit):
        main(["--kafka", "host:9092", "--out", "/out"])
    assert "--max-offsets-per-trigger" in capsys.readouterr().err


def test_stall_raises_one_alert():
    """A timer that fires long after its tick alerts once, for the latest tick."""
    from fleetlens.streaming.processors import OffGridProcessor

    class Clock:
        getCurrentProcessingTimeInMs = staticmethod(lambda: 10_000_000)  # noqa: N815

    class Fired:
        getExpiryTimeInMs = staticmethod(lambda: 1_020_000)  # noqa: N815

    class Seen:
        exists = staticmethod(lambda: True)
        get = staticmethod(lambda: ("r1", "Route 1", 0.0, 0.0, 700_000))

    timers = []
    p = OffGridProcessor(JobSettings())
    p.seen = Seen
    p.handle = type("H", (), {"registerTimer": staticmethod(timers.append)})
    (out,) = list(p.handleExpiredTimer(("A",), Clock, Fired))
    assert out["silenceDurationMs"].tolist() == [9_960_000 - 700_000]
    assert timers == [10_020_000]
