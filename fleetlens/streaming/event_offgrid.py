"""Silence alerts on event time, with event-time timers.

The wall-clock detector (``processors.OffGridProcessor``) answers "who is
silent now"; replaying stored pings through it alerts nobody, or everybody. On
event time the clock is the query's watermark: a vehicle is due at the first
tick more than the silence threshold after its last ping, and again at the next
tick while it stays silent. Vehicles are held in groups
(``processors.in_groups``); a group has one timer, at the first tick at which
one of its vehicles is due, and judges all of them at once. A tick is raised
once the watermark has passed it, so every ping up to the tick has been seen
(pings later than ``delay`` are dropped by the watermark). A ping that ends a
silence first raises the ticks before it that no timer has raised yet. The step
gives a row for each run of ticks of a ping; the ticks themselves are made by
Spark (``sequence``, ``explode``), as in the batch form.

Ticks are multiples of the check interval, silence is counted in whole
milliseconds, both as in the batch form ``operators.offgrid.tick_alerts``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetlens.functions.scalar import epoch_micros, from_epoch_micros
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings
from fleetlens.streaming.processors import GROUP, in_groups, places

SPAN = (
    "matatuId string, routeId string, routeName string, latitude double, longitude double, "
    "seen long, firstTick long, lastTick long"
)
# State of a group: for each vehicle its last ping (``seen``, microseconds) and
# the last tick judged for it (``raised``, a tick number).
LAST_SEEN = (
    "matatuId array<string>, routeId array<string>, routeName array<string>, latitude array<double>, "
    "longitude array<double>, seen array<bigint>, raised array<bigint>"
)
STATE = {
    "matatuId": object, "routeId": object, "routeName": object, "latitude": np.float64, "longitude": np.float64,
    "seen": np.int64, "raised": np.int64,
}
PING = list(STATE)[:-1]
NEVER = -(1 << 62)


class EventTimeOffGrid(StatefulProcessor):
    def __init__(self, settings: JobSettings = DEFAULT_SETTINGS) -> None:
        self.silence = settings.offgrid_silence_ms
        self.step = settings.offgrid_check_interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("lastSeen", LAST_SEEN)

    def _kept(self) -> list[np.ndarray]:
        """The group's state, an array a column."""
        had = self.last.get() if self.last.exists() else [[] for _ in STATE]
        return [np.array(list(column), dtype=t) for column, t in zip(had, STATE.values())]

    def _keep(self, state: list[np.ndarray]) -> None:
        """Store the state; the group's timer is due when its first vehicle is."""
        self.last.update(tuple(column.tolist() for column in state))
        *_, seen, raised = state
        due = int(self._due(seen, raised).min()) * self.step + 1  # a tick is judged when the watermark has passed it
        timers = list(self.handle.listTimers())
        for timer in timers:
            if timer != due:
                self.handle.deleteTimer(timer)
        if due not in timers:
            self.handle.registerTimer(due)

    def _due(self, seen: np.ndarray, raised: np.ndarray) -> np.ndarray:
        """The first tick over the threshold after a ping that is not yet judged."""
        first = -(-(seen // 1000 + self.silence + 1) // self.step)
        return np.maximum(first, raised + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = pd.concat(list(rows), ignore_index=True).sort_values(["seen", "eventId"], kind="stable")
        *kept, raised = self._kept()
        place, vehicles = places(df["matatuId"], kept[0].tolist())
        old = np.unique(place[place < len(raised)])
        raised = np.concatenate((raised, np.full(len(vehicles) - len(raised), NEVER)))
        # the last pings known, then the new ones, by vehicle and time; a ping
        # before the last one changes nothing after it
        at = np.concatenate((old, place))
        pings = [np.concatenate((had[old], df[c].to_numpy(STATE[c]))) for c, had in zip(PING, kept)]
        order = np.lexsort((pings[-1], at))
        at, pings = at[order], [column[order] for column in pings]
        seen = pings[-1]
        low = self._due(seen[:-1], raised[at[:-1]])
        high = (seen[1:] - 1) // (self.step * 1000)
        alerting = (at[1:] == at[:-1]) & (high >= low)
        yield self._spans([column[:-1][alerting] for column in pings], low[alerting], high[alerting])
        last = np.flatnonzero(np.concatenate((at[1:] != at[:-1], [True])))
        after = []
        for had, column in zip(kept, pings):
            grown = np.concatenate((had, np.empty(len(raised) - len(had), dtype=had.dtype)))
            grown[at[last]] = column[last]
            after.append(grown)
        self._keep([*after, raised])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        *pings, raised = self._kept()
        # ticks strictly before the watermark: a ping at the watermark may still come
        upto = (timerValues.getCurrentWatermarkInMs() - 1) // self.step
        low = self._due(pings[-1], raised)
        due = low <= upto
        yield self._spans([column[due] for column in pings], low[due], np.full(int(due.sum()), upto, dtype=np.int64))
        raised[due] = upto
        self._keep([*pings, raised])

    def _spans(self, pings: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({**dict(zip(PING, pings)), "firstTick": first, "lastTick": last})

    def close(self) -> None:
        pass


def offgrid_flow(
    locations: DataFrame,
    settings: JobSettings = DEFAULT_SETTINGS,
    delay: str = "0 seconds",
    step: EventTimeOffGrid | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """One row for each vehicle and alerting tick the watermark has passed.
    ``step`` and ``initial`` start it from a history (see ``handover``)."""
    pings = locations.filter("timestamp IS NOT NULL").withWatermark("timestamp", delay)
    rows = pings.select(
        "matatuId", "routeId", "routeName", "latitude", "longitude", "timestamp", "eventId",
        epoch_micros(pings, "timestamp").alias("seen"),
    )
    if initial is not None:
        initial = in_groups(initial, ["matatuId"], settings.key_groups).groupBy(GROUP)
    spans = in_groups(rows, ["matatuId"], settings.key_groups).groupBy(GROUP).transformWithStateInPandas(
        statefulProcessor=step or EventTimeOffGrid(settings), outputStructType=SPAN, outputMode="Append",
        timeMode="EventTime", initialState=initial,
    )
    ticks = F.explode(F.sequence("firstTick", "lastTick")).alias("tick")
    return spans.select(*PING, ticks)


def alerts(flow: DataFrame, settings: JobSettings = DEFAULT_SETTINGS, ntz: bool = False) -> DataFrame:
    """The alert records of :func:`offgrid_flow`'s rows."""
    at = F.col("tick") * F.lit(settings.offgrid_check_interval_ms)
    seen_ms = F.expr("seen div 1000")
    return flow.select(
        "matatuId", "routeId", "routeName", F.col("latitude").alias("lastKnownLatitude"),
        F.col("longitude").alias("lastKnownLongitude"), (at - seen_ms).alias("silenceDurationMs"),
        from_epoch_micros(F.col("seen"), ntz).alias("lastSeenAt"), from_epoch_micros(at * 1000, ntz).alias("alertRaisedAt"),
    )
