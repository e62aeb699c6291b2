"""Stateful steps that hold many keys in a group: each key is folded on its own,
and a call costs by the group, not by the key."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd

from fixtures_small import at
from fleetlens.operators import offgrid
from fleetlens.settings import JobSettings
from fleetlens.streaming import event_offgrid, processors


class GroupState:
    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def frame(rows, names):
    return pd.DataFrame(rows, columns=names)


def test_a_call_folds_every_vehicle_of_its_group():
    """Two micro-batches, a vehicle in both, one without an id, ties in time."""
    names = ["matatuId", "routeId", "routeName", "passengersOnboard", "timestamp", "eventId"]
    state = GroupState()
    first = frame([("B", "r2", "R", 4, at(2), 3), ("A", "r1", "R", 5, at(1), 2), ("A", "r1", "R", 7, at(1), 1), (None, "r1", "R", 9, at(0), 0)], names)
    got = pd.concat(processors.passenger_deltas_with_state((0,), iter([first.iloc[:2], first.iloc[2:]]), state))
    assert dict(zip(got["eventId"], got["passengerDelta"])) == {0: 9, 1: 7, 2: -2, 3: 4}
    later = frame([("A", "r3", "R", 1, at(5), 5), ("C", "r1", "R", 2, at(4), 4), (None, "r1", "R", 8, at(6), 6)], names)
    got = pd.concat(processors.passenger_deltas_with_state((0,), iter([later]), state))
    assert dict(zip(got["eventId"], got["passengerDelta"])) == {4: 2, 5: -4, 6: -1}
    assert got["boardings"].sub(got["alightings"]).tolist() == got["passengerDelta"].tolist()
    assert set(zip(*state.get)) == {("A", "r3", 1), ("B", "r2", 4), ("C", "r1", 2), (None, "r1", 8)}


def test_a_call_sums_up_every_chunk_of_its_group():
    rng = random.Random(3)
    names = ["routeId", "routeName", "chunk", "passengerDelta", "boardings", "alightings", "timestamp", "eventId"]
    rows = [(rng.choice(["r1", "r2", None]), f"R{i}", c := rng.randrange(4), d := rng.randrange(-9, 10), max(0, d), max(0, -d), at(c), i) for i in range(90)]
    (got,) = processors.RouteChunkSummarizer().handleInputRows((0,), iter([frame(rows, names)]), None)
    groups = {(r[0], r[2]) for r in rows}
    assert len(got) == len(groups) == 12
    for r in got.to_dict("records"):
        mine = [x for x in rows if (x[0], x[2]) == (r["routeId"], r["chunk"])]
        for start in (0, 3, 40):
            c = start
            for x in mine:
                c = max(0, c + x[3])
            assert max(start + r["sumDelta"], r["floorAfter"]) == c
        assert (r["boardings"], r["alightings"]) == (sum(x[4] for x in mine), sum(x[5] for x in mine))
        assert (r["routeName"], r["eventId"]) == (mine[-1][1], mine[-1][7])


class Handle:
    """A group's value and timers in memory."""

    def __init__(self):
        self.value, self.timers = None, set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def getValueState(self, *_):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def listTimers(self):
        return iter(sorted(self.timers))


class Clock:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = lambda: ms


def test_one_timer_judges_every_vehicle_of_its_group(spark):
    """Micro-batches of random pings of twelve vehicles in one group, timers
    after each, against the batch form."""
    rng = random.Random(8)
    s = JobSettings(offgrid_silence_ms=300_000, offgrid_check_interval_ms=60_000)
    t, pings = 0.0, []
    for i in range(240):
        t += rng.choice([0.0, 0.2, 1.3, 6.0])
        pings.append((f"KBZ {rng.randrange(12)}", "r", "R", float(i), 1.0, at(t) + dt.timedelta(microseconds=rng.randrange(1, 999)), i))
    pings.sort(key=lambda p: (p[5], p[6]))
    us = [round((p[5] - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000) for p in pings]
    rows = frame([(*p[:5], n, p[6]) for p, n in zip(pings, us)], [*event_offgrid.PING, "eventId"])
    handle, spans, calls = Handle(), [], 0
    step = event_offgrid.EventTimeOffGrid(s)
    step.init(handle)
    for k in range(0, 240, 60):
        spans += step.handleInputRows((0,), iter([rows.iloc[k : k + 60]]), Clock(0))
        assert len(handle.timers) == 1
        clock = Clock(us[k + 59] // 1000)
        if min(handle.timers) <= clock.getCurrentWatermarkInMs():
            handle.timers.clear()
            spans += step.handleExpiredTimer((0,), clock, None)
        calls += 1
    got = sorted((v, seen, k) for f in spans for v, seen, a, b in zip(f["matatuId"], f["seen"], f["firstTick"], f["lastTick"]) for k in range(a, b + 1))
    schema = "matatuId string, routeId string, routeName string, latitude double, longitude double, timestamp timestamp_ntz, eventId long"
    want = offgrid.tick_alerts(spark.createDataFrame(pings, schema), None, s).selectExpr(
        "matatuId", "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', lastSeenAt) AS seen",
        "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', alertRaisedAt) div 60000000 AS k",
    )
    assert got == sorted(tuple(r) for r in want.collect())
    assert len(got) > 300


def test_alerts_are_spread_before_they_expand(spark):
    """The gaps of few pings fit one shuffle partition; their alerts are many
    times as many rows and must not all be made in that one task."""
    pings = [(f"KBZ {v}", "r", "R", 0.0, 0.0, dt.datetime(2024, 1, 1, h), 100 * v + h) for v in range(30) for h in (0, 23)]
    schema = "matatuId string, routeId string, routeName string, latitude double, longitude double, timestamp timestamp_ntz, eventId long"
    alerts = offgrid.tick_alerts(spark.createDataFrame(pings, schema))
    assert alerts.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
