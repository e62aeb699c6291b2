"""Hand-written edge cases: thresholds, boundaries, defaults, clamps."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from fixtures_small import at, fares, pings
from fleetlens.functions.scalar import java_string_hash
from fleetlens.operators import occupancy, offgrid, revenue, routing, stateless
from fleetlens.settings import JobSettings
from fleetlens.sources import codec
from fleetlens.sources.dimension import sacco_dim


def test_speed_threshold_is_strict(spark):
    df = pings(spark, [("A", "route_33", 80.0, 1, at(0)), ("B", "route_33", 80.01, 1, at(1))])
    got = [r.matatuId for r in stateless.speed_alerts(df).collect()]
    assert got == ["B"]


def test_invalid_records_are_quarantined_with_reason(spark):
    df = pings(
        spark,
        [
            ("A", "route_33", -1.0, 1, at(0)),
            ("  ", "route_33", 10.0, 1, at(1)),
            ("C", "", 10.0, 1, at(2)),
            ("D", "route_33", 0.0, 1, at(3)),
        ],
    )
    valid, bad = codec.split_valid(df, "location")
    assert [r.matatuId for r in valid.collect()] == ["D"]
    reasons = {r.eventId: r.invalidReason for r in bad.collect()}
    assert reasons == {
        0: codec.REASON_NEGATIVE_SPEED,
        1: codec.REASON_BLANK_MATATU,
        2: codec.REASON_BLANK_ROUTE,
    }


def test_malformed_json_and_bad_enums_are_quarantined(spark):
    raw = spark.createDataFrame(
        [
            ("k", '{"transactionId":"T1","matatuId":"A","passengerId":"P","amountKes":5,'
             '"paymentMethod":"MPESA","status":"SUCCESS","timestamp":"2024-01-01T09:00:00Z"}'),
            ("k", '{"transactionId":"T2","matatuId":"A","passengerId":"P","amountKes":5,'
             '"paymentMethod":"BITCOIN","status":"SUCCESS","timestamp":"2024-01-01T09:00:00Z"}'),
            ("k", "not json"),
        ],
        "key string, value string",
    )
    valid, bad = codec.split_valid(codec.decode(raw, codec.FARE_EVENT), "fare")
    assert [r.transactionId for r in valid.collect()] == ["T1"]
    assert sorted(r.invalidReason for r in bad.collect()) == sorted(
        [codec.REASON_BAD_METHOD, codec.REASON_MALFORMED]
    )


def test_unknown_route_gets_default_operator(spark):
    df = pings(spark, [("A", "route_99", 10.0, 1, at(0)), ("B", "route_33", 90.0, 1, at(1))])
    rows = {
        r.matatuId: r
        for r in stateless.enrich_locations(df, sacco_dim(spark), small_dim=True).collect()
    }
    assert (rows["A"].saccoId, rows["A"].saccoName, rows["A"].terminus) == (
        "unknown",
        "Unknown Sacco",
        "Unknown Terminus",
    )
    assert (rows["B"].saccoId, rows["B"].saccoName, rows["B"].isSpeeding) == ("sacco_01", "Citi Hoppa", True)
    report = stateless.unknown_routes(df, sacco_dim(spark), True).collect()
    assert [(r.routeId, r.pings, r.vehicles) for r in report] == [("route_99", 1, 1)]


def test_first_ping_and_repeated_count(spark):
    df = pings(spark, [("A", "route_33", 10.0, 7, at(0)), ("A", "route_33", 10.0, 7, at(1))])
    rows = occupancy.passenger_deltas(df).orderBy("eventId").collect()
    assert [(r.passengerDelta, r.boardings, r.alightings) for r in rows] == [(7, 7, 0), (0, 0, 0)]


def test_route_switch_clamps_new_route(spark):
    df = pings(
        spark,
        [
            ("A", "r1", 10.0, 20, at(0)),
            ("A", "r1", 10.0, 25, at(1)),
            ("B", "r1", 10.0, 3, at(2)),
            ("A", "r2", 10.0, 5, at(3)),
        ],
    )
    deltas = occupancy.passenger_deltas(df)
    assert [r.passengerDelta for r in deltas.orderBy("eventId").collect()] == [20, 5, 3, -20]
    final = {r.routeId: r for r in occupancy.route_occupancy(deltas).collect()}
    assert final["r1"].currentPassengers == 28
    assert final["r2"].currentPassengers == 0
    assert (final["r2"].totalBoardings, final["r2"].totalAlightings) == (0, 20)
    log = occupancy.occupancy_changelog(deltas).orderBy("eventId").collect()
    assert [(r.routeId, r.currentPassengers) for r in log] == [("r1", 20), ("r1", 25), ("r1", 28), ("r2", 0)]


def test_silence_threshold_is_strict(spark):
    df = pings(spark, [("A", "route_33", 10.0, 1, at(0))])
    exactly = offgrid.offgrid_as_of(df, F.lit(at(ms=300_000)))
    above = offgrid.offgrid_as_of(df, F.lit(at(ms=300_001)))
    assert exactly.count() == 0
    assert [r.silenceDurationMs for r in above.collect()] == [300_001]


def test_silence_alerts_at_every_later_tick(spark):
    # Ping at 09:00:00.000; ticks every minute. 09:05 sees exactly 300000 ms
    # (no alert); 09:06..09:10 alert (horizon 09:10).
    df = pings(spark, [("A", "route_33", 10.0, 1, at(0))])
    ticks = offgrid.tick_alerts(df, F.lit(at(10))).orderBy("alertRaisedAt").collect()
    assert [r.silenceDurationMs for r in ticks] == [360_000, 420_000, 480_000, 540_000, 600_000]
    gaps = offgrid.silence_gaps(df, F.lit(at(10))).collect()
    assert [(g.alertCount, g.maxSilenceMs) for g in gaps] == [(5, 600_000)]
    # one millisecond earlier and the 09:05 tick alerts too
    df2 = pings(spark, [("A", "route_33", 10.0, 1, at(0, ms=-1))])
    assert offgrid.silence_gaps(df2, F.lit(at(10))).collect()[0].alertCount == 6


def test_a_new_ping_ends_the_silence(spark):
    df = pings(spark, [("A", "route_33", 10.0, 1, at(0)), ("A", "route_33", 10.0, 1, at(7, ms=30_000))])
    ticks = offgrid.tick_alerts(df, F.lit(at(8))).collect()
    # gap 09:00 -> 09:07:30: ticks 09:06, 09:07 alert; after 09:07:30 silence < 5 min
    assert sorted(r.alertRaisedAt for r in ticks) == [at(6), at(7)]


def test_window_boundaries(spark):
    df = fares(spark, [("KBZ 1", "1.00", "SUCCESS", at(59, ms=59_000)), ("KBZ 1", "2.00", "SUCCESS", at(60))])
    rows = revenue.windowed_revenue(df).orderBy("windowStart").collect()
    assert [(r.windowStart, r.windowEnd, r.totalRevenueKes) for r in rows] == [
        (at(0), at(60), Decimal("1.00")),
        (at(60), at(120), Decimal("2.00")),
    ]


def test_window_closes_at_end_plus_grace(spark):
    base = [("KBZ 1", "10.00", "SUCCESS", at(10))]
    not_yet = fares(spark, base + [("KBZ 1", "1.00", "SUCCESS", at(64, ms=59_999))])
    closes = fares(spark, base + [("KBZ 1", "1.00", "SUCCESS", at(65))])
    assert revenue.emitted_revenue(not_yet).count() == 0
    assert [r.windowStart for r in revenue.emitted_revenue(closes).collect()] == [at(0)]


def test_late_fare_after_window_closed_is_dropped(spark):
    df = fares(
        spark,
        [
            ("KBZ 1", "10.00", "SUCCESS", at(10)),
            ("KBZ 1", "100.00", "SUCCESS", at(20)),
            ("KBZ 1", "5.00", "SUCCESS", at(66)),
            ("KBZ 1", "1000.00", "SUCCESS", at(30), at(67)),  # arrives after 10:05
        ],
    )
    late = revenue.late_fares(df).collect()
    assert [r.amountKes for r in late] == [Decimal("1000.00")]
    win = [r for r in revenue.emitted_revenue(df).collect() if r.windowStart == at(0)]
    assert [(r.totalRevenueKes, r.transactionCount) for r in win] == [(Decimal("110.00"), 2)]


def test_pending_goes_to_default_branch(spark):
    df = fares(spark, [("A", "1", "FAILED", at(0)), ("A", "1", "SUCCESS", at(1)), ("A", "1", "PENDING", at(2))])
    assert [r.branch for r in routing.label_branches(df).orderBy("eventId").collect()] == [
        "failed",
        "success",
        "default",
    ]
    assert routing.failed_fares(df).count() == 1


def _java_hash(s: str) -> int:
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    return h & 0x7FFFFFFF


def test_java_string_hash(spark):
    words = ["KBZ 123A", "", "é", "a\U0001F600b", "KBZ 149", "route_111"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r.h for r in df.select(java_string_hash("s").alias("h")).collect()]
    assert got[0] == 767659116
    assert got == [_java_hash(w) for w in words]


def test_sacco_key_mode(spark):
    df = fares(spark, [("KBZ 123A", "1.00", "SUCCESS", at(0))])
    idx = 767659116 % 5
    route_mode = revenue.assign_operator(df, JobSettings()).first().saccoId
    sacco_mode = revenue.assign_operator(df, JobSettings(revenue_key_mode="sacco")).first().saccoId
    assert route_mode == sorted(["route_33", "route_23", "route_58", "route_111", "route_46"])[idx]
    assert sacco_mode == f"sacco_0{idx + 1}"


def test_materialised_deltas_give_the_same_changelog(spark):
    from fleetlens.sources.fixtures import load_locations

    deltas = occupancy.passenger_deltas(load_locations(spark, "/root/testdata/sf0.001"))
    forced = occupancy.occupancy_changelog(deltas, materialize=True)
    plain = occupancy.occupancy_changelog(deltas, materialize=False)
    assert "tables/passenger_deltas-" in " ".join(forced.inputFiles())
    assert forced.count() == plain.count() == 599
    assert forced.exceptAll(plain).count() == 0


def test_offgrid_alert_message_in_whole_minutes(spark):
    from fleetlens.operators import taps

    df = pings(spark, [("A", "route_33", 10.0, 1, at(0))])
    alerts = offgrid.offgrid_as_of(df, F.lit(at(6, ms=59_999)))
    msg = taps.offgrid_messages(alerts).first().message
    assert "has been silent for 6 minutes" in msg and msg.startswith("[OFF-GRID] 📡 Matatu A on Route 33")


def test_log_lines_print_values_as_java_does(spark):
    from fleetlens.operators import taps

    df = spark.createDataFrame(
        [(at(0),), (at(0, ms=123),), (at(0) + dt.timedelta(microseconds=123456),)], "t timestamp_ntz"
    )
    got = [r.s for r in df.select(taps.instant_string(df, "t").alias("s")).collect()]
    assert got == ["2024-01-01T09:00:00Z", "2024-01-01T09:00:00.123Z", "2024-01-01T09:00:00.123456Z"]
    locs = pings(spark, [("A", "r1", 12.5, 20, at(0)), ("A", "r1", 80.0, 25, at(1))])
    deltas = occupancy.passenger_deltas(locs)
    lines = [r.message for r in taps.delta_messages(deltas).orderBy("eventId").collect()]
    assert lines == ["[DELTA] 🚌 A | prev=0 cur=20 delta=20", "[DELTA] 🚌 A | prev=20 cur=25 delta=5"]
    log = taps.location_log_messages(locs).orderBy("eventId").first().message
    assert log == "[LOGGER] 📝 Persisting → matatu=A, route=r1, lat=-1.29, lng=36.82, speed=12.5, offset=0"
    occ = taps.occupancy_messages(occupancy.occupancy_changelog(deltas)).orderBy("eventId").collect()
    assert occ[-1].message == "[OCCUPANCY] 🚌 Route r1 | On board: 25 | Boarded: 25 | Alighted: 0"


def test_operators_accept_empty_input(spark):
    from fleetlens.sources.dimension import sacco_dim

    locs = pings(spark, [("A", "r1", 1.0, 1, at(0))]).limit(0)
    fs = fares(spark, [("A", "1.00", "SUCCESS", at(0))]).limit(0)
    frames = [
        stateless.speed_alerts(locs),
        stateless.enrich_locations(locs, sacco_dim(spark), small_dim=True),
        stateless.unknown_routes(locs, sacco_dim(spark), True),
        occupancy.passenger_deltas(locs),
        occupancy.occupancy_changelog(occupancy.passenger_deltas(locs)),
        occupancy.route_occupancy(occupancy.passenger_deltas(locs)),
        occupancy.vehicle_snapshots(locs),
        offgrid.last_seen(locs),
        offgrid.offgrid_as_of(locs),
        offgrid.silence_gaps(locs),
        offgrid.tick_alerts(locs),
        revenue.windowed_revenue(fs),
        revenue.late_fares(fs),
        revenue.emitted_revenue(fs),
        routing.branch_summary(fs),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_views_for_spark_sql(spark):
    from fleetlens.sources.fixtures import register_views

    register_views(spark, "/root/testdata/sf0.001")
    got = spark.sql(
        """SELECT count(*) AS n, count_if(d.saccoId IS NULL) AS unknown
           FROM locations l LEFT JOIN sacco_dim d USING (routeId)"""
    ).first()
    assert (got.n, got.unknown) == (599, 98)
    assert spark.sql("SELECT count(*) FROM fares WHERE status = 'FAILED'").first()[0] == 43


def test_floor_division_is_exact_beyond_doubles(spark):
    from fleetlens.functions.scalar import ceil_div, floor_div

    df = spark.createDataFrame([(9100000000000000001,), (-9100000000000000001,), (-7,), (7,)], "a long")
    got = [tuple(r) for r in df.select(floor_div(F.col("a"), 3), ceil_div(F.col("a"), 3)).collect()]
    assert got == [(a // 3, -(-a // 3)) for a in (9100000000000000001, -9100000000000000001, -7, 7)]
    plan = df.select(floor_div(F.col("a"), 3))._jdf.queryExecution().executedPlan().toString()
    assert "double" not in plan


def test_missing_passenger_count_is_zero(spark):
    from fleetlens.schemas import LOCATION_EVENT
    from fleetlens.sources import codec

    line = '{"matatuId":"A","routeId":"r","speedKmh":1.0,"timestamp":"2024-01-01T09:00:00Z"}'
    df = spark.createDataFrame([(line,)], "value string")
    valid, bad = codec.split_valid(codec.decode(df, LOCATION_EVENT), "location")
    assert valid.first().passengersOnboard == 0 and bad.count() == 0
