"""Stateful per-key steps of the streaming flows.

Each step gathers all rows of its key in the micro-batch, orders them by
(timestamp, eventId) - Spark gives no order inside a group - and folds them
with vectorised numpy. Groups are bounded by the trigger size
(``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``).

Steps with many keys per micro-batch (vehicles, chunks of routes) group by a
hash of the key (``in_groups``): a call folds all keys of a group at once, and
their state is one value of parallel arrays, an element a key. A call per key
costs milliseconds, whatever few rows the key has.

The per-vehicle delta step is an ``applyInPandasWithState`` function: its state
travels with the group's data (no state round trip). The per-route steps and
the silence detector (processing-time timers on a shared tick grid) are
``transformWithStateInPandas`` processors; Spark allows only one
``applyInPandasWithState`` per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState

from fleetlens.schemas import DELTA_EVENT, OFFGRID_ALERT, ROUTE_OCCUPANCY
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings

_ORDER_FIELDS = [
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("eventId", T.LongType()),
]

# Output records: the published record shapes plus the ordering fields.
DELTA_OUT = T.StructType([*DELTA_EVENT.fields, *_ORDER_FIELDS])
OCCUPANCY_OUT = T.StructType(
    [f for f in ROUTE_OCCUPANCY.fields if f.name != "lastUpdated"]
    + _ORDER_FIELDS
    + [f for f in ROUTE_OCCUPANCY.fields if f.name == "lastUpdated"]
)
OFFGRID_OUT = OFFGRID_ALERT

# State of a group of vehicles.
SNAPSHOT_STATE = "matatuId array<string>, routeId array<string>, lastPassengerCount array<int>"
GROUP = "_group"

# Composable effect of one (route, chunk) of deltas; see route_chunk_summaries.
CHUNK_SUMMARY_OUT = T.StructType(
    [
        T.StructField("routeId", T.StringType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("sumDelta", T.LongType()),
        T.StructField("floorAfter", T.LongType()),
        T.StructField("boardings", T.LongType()),
        T.StructField("alightings", T.LongType()),
        T.StructField("routeName", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("eventId", T.LongType()),
    ]
)


def _gather(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = list(rows)
    df = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
    order = [c for c in ("timestamp", "eventId") if c in df.columns]
    return df.sort_values(order, kind="stable", na_position="first").reset_index(drop=True)


def _empty(schema: T.StructType) -> pd.DataFrame:
    dtypes = {
        T.StringType: "object",
        T.IntegerType: "int32",
        T.LongType: "int64",
        T.DoubleType: "float64",
        T.TimestampType: "datetime64[ns]",
    }
    return pd.DataFrame(
        {f.name: pd.Series([], dtype=dtypes[type(f.dataType)]) for f in schema.fields}
    )


def _ms_to_ts(ms) -> pd.Series | pd.Timestamp:
    return pd.to_datetime(ms, unit="ms")


def _now() -> pd.Timestamp:
    return pd.Timestamp.now(tz="UTC").tz_localize(None)


def _event_ids(df: pd.DataFrame) -> pd.Series:
    if "eventId" in df.columns:
        return df["eventId"].astype("Int64")
    return pd.Series([None] * len(df), dtype="Int64")


def in_groups(rows: DataFrame, keys: list[str], groups: int) -> DataFrame:
    """Adds the number of the group that a row's key falls into."""
    return rows.withColumn(GROUP, F.pmod(F.xxhash64(*keys), F.lit(groups).cast("bigint")))


def places(keys: pd.Series, known: list) -> tuple[np.ndarray, list]:
    """Each row's place of its key in ``known``, and ``known`` with the new
    keys at its end."""
    codes, names = pd.factorize(keys, use_na_sentinel=False)
    at = {k: i for i, k in enumerate(known)}
    place = [at.setdefault(None if pd.isna(k) else k, len(at)) for k in names]
    return np.array(place, dtype=np.int64)[codes], list(at)


def fold_counts(rows: Iterator[pd.DataFrame], state: tuple | None) -> tuple[pd.DataFrame, tuple]:
    """Deltas of a group's vehicles after ``state`` (vehicles, their last route
    and count), and the state after them."""
    df = _gather(rows)
    known, routes, before = state or ([], [], [])
    place, vehicles = places(df["matatuId"], known)
    by_vehicle = np.argsort(place, kind="stable")
    df, place = df.iloc[by_vehicle].reset_index(drop=True), place[by_vehicle]
    new = len(vehicles) - len(known)
    last_counts = np.concatenate((np.array(before, dtype=np.int64), np.zeros(new, dtype=np.int64)))
    first = np.concatenate(([True], place[1:] != place[:-1]))
    last = np.flatnonzero(np.concatenate((first[1:], [True])))
    counts = df["passengersOnboard"].to_numpy(dtype=np.int64)
    delta = counts - np.where(first, last_counts[place], np.roll(counts, 1))
    last_counts[place[last]] = counts[last]
    routes = [*routes, *[None] * new]
    for vehicle, route in zip(place[last], df["routeId"].iloc[last]):
        routes[vehicle] = str(route)
    out = pd.DataFrame(
        {
            "matatuId": df["matatuId"],
            "routeId": df["routeId"],
            "routeName": df["routeName"],
            "passengerDelta": delta.astype("int32"),
            "boardings": np.maximum(0, delta).astype("int32"),
            "alightings": np.maximum(0, -delta).astype("int32"),
            "timestamp": df["timestamp"],
            "eventId": _event_ids(df),
        }
    )
    return out, (vehicles, routes, last_counts.tolist())


def passenger_deltas_with_state(
    key: tuple, rows: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """Per vehicle of a group: delta to the previous passenger count (0 before
    the first ping), boardings and alightings; zero deltas are emitted too.
    State: each vehicle's last route and count."""
    out, after = fold_counts(rows, tuple(state.get) if state.exists else None)
    state.update(after)
    yield out


class RouteOccupancyProcessor(StatefulProcessor):
    """Per route: ``current = max(0, current + delta)`` and running totals.

    Vectorised closed form with a carried start value c >= 0:
    ``x_n = c + S_n - min(0, c + min(S_1..S_n))`` where S is the prefix sum.
    ``every_update`` emits one row per delta (the full changelog); otherwise
    one row per changed route per micro-batch (commit-interval coalescing).
    """

    def __init__(self, every_update: bool = True) -> None:
        self.every_update = every_update

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.occ = handle.getValueState(
            "occupancy",
            "routeName string, currentPassengers int, totalBoardings long, totalAlightings long",
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _gather(rows)
        if self.occ.exists():
            _, cur, tb, ta = self.occ.get()
        else:
            cur, tb, ta = 0, 0, 0
        d = df["passengerDelta"].to_numpy(dtype=np.int64)
        s = np.cumsum(d)
        current = cur + s - np.minimum(0, cur + np.minimum.accumulate(s))
        boards = tb + np.cumsum(df["boardings"].to_numpy(dtype=np.int64))
        alights = ta + np.cumsum(df["alightings"].to_numpy(dtype=np.int64))
        name = df["routeName"].iloc[-1]
        self.occ.update((name, int(current[-1]), int(boards[-1]), int(alights[-1])))
        now = _now()  # no timers here: the processor runs without a time mode
        out = pd.DataFrame(
            {
                "routeId": df["routeId"],
                "routeName": df["routeName"],
                "currentPassengers": current.astype("int32"),
                "totalBoardings": boards,
                "totalAlightings": alights,
                "timestamp": df["timestamp"],
                "eventId": _event_ids(df),
                "lastUpdated": now,
            }
        )
        yield out if self.every_update else out.tail(1)

    def close(self) -> None:
        pass


class RouteChunkSummarizer(StatefulProcessor):
    """Per (route, time chunk) of one micro-batch, no state: the composable
    effect of the chunk's ordered deltas on the clamped occupancy. A group
    holds many such chunks, the chunk's number in column ``chunk``.

    Over deltas with prefix sums S_1..S_n the fold maps a start value c to
    ``max(c + b, a)`` with ``b = S_n`` and ``a = S_n - min(S_1..S_n)``;
    such maps compose, so a route's chunks are folded in parallel and only
    their summaries meet in the per-route state.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _gather(rows)
        route, _ = places(df["routeId"], [])
        chunk = df["chunk"].to_numpy(dtype=np.int64)
        by_chunk = np.lexsort((chunk, route))  # stable: in a chunk the order is that of _gather
        df, route, chunk = df.iloc[by_chunk].reset_index(drop=True), route[by_chunk], chunk[by_chunk]
        first = np.concatenate(([True], (route[1:] != route[:-1]) | (chunk[1:] != chunk[:-1])))
        start, last = np.flatnonzero(first), np.flatnonzero(np.concatenate((first[1:], [True])))
        s = np.cumsum(df["passengerDelta"].to_numpy(dtype=np.int64))
        before = np.concatenate(([0], s[start[1:] - 1]))
        ends = df.iloc[last].reset_index(drop=True)
        yield pd.DataFrame(
            {
                "routeId": ends["routeId"],
                "chunk": chunk[last],
                "sumDelta": s[last] - before,
                "floorAfter": s[last] - np.minimum.reduceat(s, start),
                "boardings": np.add.reduceat(df["boardings"].to_numpy(dtype=np.int64), start),
                "alightings": np.add.reduceat(df["alightings"].to_numpy(dtype=np.int64), start),
                "routeName": ends["routeName"],
                "timestamp": ends["timestamp"],
                "eventId": _event_ids(ends),
            }
        )

    def close(self) -> None:
        pass


class RouteOccupancyFromChunks(StatefulProcessor):
    """Per route: applies the micro-batch's chunk summaries in chunk order to
    the stored occupancy and emits one row per changed route (the coalesced
    changelog a commit interval produces)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.occ = handle.getValueState(
            "occupancy",
            "routeName string, currentPassengers int, totalBoardings long, totalAlightings long",
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        df = (pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]).sort_values("chunk")
        if self.occ.exists():
            _, cur, tb, ta = self.occ.get()
        else:
            cur, tb, ta = 0, 0, 0
        for b, a in zip(df["sumDelta"].to_numpy(dtype=np.int64), df["floorAfter"].to_numpy(dtype=np.int64)):
            cur = max(cur + int(b), int(a))
        tb += int(df["boardings"].sum())
        ta += int(df["alightings"].sum())
        last = df.iloc[-1]
        self.occ.update((last["routeName"], int(cur), int(tb), int(ta)))
        yield pd.DataFrame(
            {
                "routeId": [key[0]],
                "routeName": [last["routeName"]],
                "currentPassengers": np.array([cur], dtype="int32"),
                "totalBoardings": [tb],
                "totalAlightings": [ta],
                "timestamp": [last["timestamp"]],
                "eventId": pd.array([last["eventId"]], dtype="Int64"),
                "lastUpdated": [_now()],
            }
        )

    def close(self) -> None:
        pass


class OffGridProcessor(StatefulProcessor):
    """Per vehicle: remembers the last ping (seen at processing time) and
    alerts at each check tick while ``tick - lastSeen > threshold``.

    Ticks are multiples of the check interval (one shared schedule). Instead
    of scanning every vehicle at every tick, each vehicle holds one timer,
    set on its first ping. When it fires, it raises one alert for the latest
    tick due (from the first tick with ``tick - lastSeen > threshold``; ticks
    missed while the query was down are not made up for) and re-arms at the
    next tick; a stale timer (the vehicle pinged since)
    just re-arms at the first tick that could alert. Pings only update the
    state (no timer calls), so a busy vehicle costs one state write per
    micro-batch. State never expires unless ``ttl_ms`` is set.
    """

    def __init__(self, settings: JobSettings = DEFAULT_SETTINGS, ttl_ms: int | None = None) -> None:
        self.threshold = settings.offgrid_silence_ms
        self.interval = settings.offgrid_check_interval_ms
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState(
            "lastSeen",
            "routeId string, routeName string, lat double, lon double, seenMs long",
            self.ttl_ms,
        )

    def _first_tick_after(self, ms: int) -> int:
        return (ms // self.interval + 1) * self.interval

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _gather(rows)
        last = df.iloc[-1]
        now = timerValues.getCurrentProcessingTimeInMs()
        first_ping = not self.seen.exists()
        self.seen.update(
            (last["routeId"], last["routeName"], float(last["latitude"]), float(last["longitude"]), now)
        )
        if first_ping:
            self.handle.registerTimer(self._first_tick_after(now + self.threshold))
        yield _empty(OFFGRID_OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tick = expiredTimerInfo.getExpiryTimeInMs()
        if not self.seen.exists():  # expired by TTL: the timer chain ends
            yield _empty(OFFGRID_OUT)
            return
        route_id, route_name, lat, lon, seen_ms = self.seen.get()
        now = max(tick, timerValues.getCurrentProcessingTimeInMs())
        first_alert = self._first_tick_after(seen_ms + self.threshold)
        # the latest tick due: a stall, however long, raises one alert
        latest = now // self.interval * self.interval
        due = np.array([latest] if latest >= max(tick, first_alert) else [], dtype=np.int64)
        self.handle.registerTimer(max(first_alert, self._first_tick_after(now)))
        if len(due) == 0:
            yield _empty(OFFGRID_OUT)
            return
        yield pd.DataFrame(
            {
                "matatuId": [key[0]] * len(due),
                "routeId": [route_id] * len(due),
                "routeName": [route_name] * len(due),
                "lastKnownLatitude": [lat] * len(due),
                "lastKnownLongitude": [lon] * len(due),
                "silenceDurationMs": due - seen_ms,
                "lastSeenAt": _ms_to_ts(np.full(len(due), seen_ms)),
                "alertRaisedAt": _ms_to_ts(due),
            }
        )

    def close(self) -> None:
        pass
