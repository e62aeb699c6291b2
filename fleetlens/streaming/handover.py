"""From batch to stream: history is folded in batch, the stream goes on.

A new stream need not read all records there ever were. The batch operators
fold the records before a cut, and their results are the initial state of the
stateful steps (``initialState``): the last count of every vehicle, the
occupancy of every route, the last ping of every vehicle. From its first
micro-batch on, the stream emits what it would have emitted had it read
everything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetlens.functions.scalar import epoch_micros
from fleetlens.operators import occupancy, offgrid
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings
from fleetlens.streaming import event_offgrid
from fleetlens.streaming.processors import (
    DELTA_OUT, GROUP, OCCUPANCY_OUT, SNAPSHOT_STATE, RouteOccupancyProcessor, fold_counts, in_groups,
)


class DeltaProcessor(StatefulProcessor):
    """Per vehicle of a group: deltas to the previous count. (The form of
    ``processors.passenger_deltas_with_state`` that takes an initial state.)"""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("snapshot", SNAPSHOT_STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        had = self.last.get() if self.last.exists() else ([], [], [])  # a large group comes in parts
        new = (initialState[c].tolist() for c in ("matatuId", "routeId", "lastPassengerCount"))
        self.last.update(tuple([*h, *n] for h, n in zip(had, new)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out, after = fold_counts(rows, tuple(self.last.get()) if self.last.exists() else None)
        self.last.update(after)
        yield out

    def close(self) -> None:
        pass


class OccupancyFromHistory(RouteOccupancyProcessor):
    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        numbers = (int(row[c]) for c in ("currentPassengers", "totalBoardings", "totalAlightings"))
        self.occ.update((row["routeName"], *numbers))


class OffGridFromHistory(event_offgrid.EventTimeOffGrid):
    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        new = (initialState[c].to_numpy(t) for c, t in event_offgrid.STATE.items())
        self._keep([np.concatenate(both) for both in zip(self._kept(), new)])  # a large group comes in parts


def occupancy_flow(later: DataFrame, history: DataFrame, every_update: bool = True, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    """The occupancy changelog of the stream ``later``, after the pings of the
    batch ``history``, all of which are before it."""
    snapshots = occupancy.vehicle_snapshots(history).select("matatuId", "routeId", "lastPassengerCount")
    snapshots = in_groups(snapshots, ["matatuId"], settings.key_groups)
    totals = occupancy.route_occupancy(occupancy.passenger_deltas(history, settings), settings)
    totals = totals.select("routeId", "routeName", "currentPassengers", "totalBoardings", "totalAlightings")
    cols = ["matatuId", "routeId", "routeName", "passengersOnboard", "timestamp", "eventId"]
    deltas = in_groups(later.select(*cols), ["matatuId"], settings.key_groups).groupBy(GROUP).transformWithStateInPandas(
        statefulProcessor=DeltaProcessor(), outputStructType=DELTA_OUT, outputMode="Append", timeMode="None",
        initialState=snapshots.groupBy(GROUP),
    )
    return deltas.groupBy("routeId").transformWithStateInPandas(
        statefulProcessor=OccupancyFromHistory(every_update), outputStructType=OCCUPANCY_OUT, outputMode="Append",
        timeMode="None", initialState=totals.groupBy("routeId"),
    )


def offgrid_flow(
    later: DataFrame, history: DataFrame, judged_tick: int, settings: JobSettings = DEFAULT_SETTINGS, delay: str = "0 seconds"
) -> DataFrame:
    """Event-time alerts of the stream ``later`` for the ticks after number
    ``judged_tick``, up to which the batch has raised them from ``history``."""
    last = offgrid.last_seen(history)
    initial = last.select(
        "matatuId", "routeId", "routeName", F.col("lastLatitude").alias("latitude"), F.col("lastLongitude").alias("longitude"),
        epoch_micros(last, "lastSeenAt").alias("seen"), F.lit(judged_tick).cast("bigint").alias("raised"),
    )
    return event_offgrid.offgrid_flow(later, settings, delay, OffGridFromHistory(settings), initial)
