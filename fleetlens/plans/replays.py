"""Streaming flows as registered queries: stored records are replayed as a
stream (``streaming.replay``), the flow runs over them micro-batch by
micro-batch with its state, and what its sink or its state stores hold
afterwards is the result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.scalar import epoch_micros, from_epoch_micros
from fleetlens.operators import increments, offgrid
from fleetlens.plans.catalog import HOURLY
from fleetlens.settings import DEFAULT_SETTINGS
from fleetlens.sources.fixtures import load_fares, load_locations
from fleetlens.streaming import event_offgrid, handover, jobs, latest, replay, sinks, state_tables, stream_time

S = DEFAULT_SETTINGS


@dataclass
class Replayed:
    """A flow that has run to the end of its input."""

    spark: SparkSession
    root: str
    outputs: dict[str, DataFrame]

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def _output(spark: SparkSession, root: str, name: str, like: DataFrame) -> DataFrame:
    """What a flow has written, also where it wrote nothing."""
    spark_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    spark_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(spark_path)
    return spark.read.schema(like.schema).parquet(f"{root}/{name}").drop("batch_id")


def _replayed(spark: SparkSession, name: str, flow: DataFrame, outputs: dict[str, Callable]) -> Replayed:
    """Run ``flow`` to the end of its input."""
    root = replay.new_folder(spark, name)
    start = partial(sinks.start_outputs, flow, outputs, f"{root}/out", root.rsplit("/", 1)[1], checkpoint=f"{root}/checkpoint")
    replay.run(start, spark)
    return Replayed(spark, root, {k: _output(spark, f"{root}/out", k, rows(flow)) for k, rows in outputs.items()})


def _fares_by_arrival(spark: SparkSession, sf: str) -> DataFrame:
    fares = replay.utc(load_fares(spark, sf), "timestamp", "arrivalTs")
    folder = replay.arrival_files(fares, ["arrivalTs", "eventId"])
    return replay.record_stream(spark, folder, fares)


def _revenue(spark: SparkSession, sf: str) -> Replayed:
    flow = stream_time.revenue_flow(_fares_by_arrival(spark, sf), S)
    outputs = {
        "windows": partial(stream_time.closed_windows, settings=S, ntz=True),
        "late": partial(stream_time.late_fares, settings=S, ntz=True),
    }
    return _replayed(spark, "revenue", flow, outputs)


def revenue_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue windows the stream emits, each once, on its operator's clock."""
    return _revenue(spark, sf).outputs["windows"]


def late_fares_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Fares the stream dropped as late."""
    return _revenue(spark, sf).outputs["late"]


def _pings_by_time(spark: SparkSession, sf: str) -> DataFrame:
    pings = replay.utc(load_locations(spark, sf), "timestamp")
    folder = replay.arrival_files(pings, ["timestamp", "eventId"])
    return replay.record_stream(spark, folder, pings)


def _zoneless(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: from_epoch_micros(epoch_micros(df, n), True) for n in names})


def open_windows_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Windows still open at the end, read from the flow's state stores, with
    the operator's clock."""
    done = _revenue(spark, sf).checkpoint
    windows = state_tables.open_windows(spark, done, ntz=True)
    return windows.join(state_tables.operator_clocks(spark, done, ntz=True), "saccoId")


def _offgrid(spark: SparkSession, sf: str) -> Replayed:
    flow = event_offgrid.offgrid_flow(_pings_by_time(spark, sf), HOURLY)
    return _replayed(spark, "offgrid", flow, {"alerts": partial(event_offgrid.alerts, settings=HOURLY, ntz=True)})


def offgrid_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of hourly checks, raised by event-time timers."""
    return _offgrid(spark, sf).outputs["alerts"]


def last_seen_state(spark: SparkSession, sf: str) -> DataFrame:
    """Last ping of every vehicle, read from the off-grid flow's state stores."""
    return state_tables.last_seen(spark, _offgrid(spark, sf).checkpoint, ntz=True)


DELTA_COLUMNS = ["matatuId", "routeId", "routeName", "passengerDelta", "boardings", "alightings", "timestamp", "eventId"]
OCCUPANCY_COLUMNS = [
    "routeId", "routeName", "currentPassengers", "totalBoardings", "totalAlightings", "timestamp", "eventId",
]


def _columns(names: list[str], batch: DataFrame) -> DataFrame:
    return _zoneless(batch.select(*names), "timestamp")


def delta_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Passenger deltas of every ping, zero deltas included."""
    flow = jobs.delta_flow(_pings_by_time(spark, sf))
    return _replayed(spark, "deltas", flow, {"deltas": partial(_columns, DELTA_COLUMNS)}).outputs["deltas"]


def _occupancy(spark: SparkSession, sf: str) -> Replayed:
    flow = jobs.occupancy_flow(jobs.delta_flow(_pings_by_time(spark, sf)))
    return _replayed(spark, "occupancy", flow, {"changelog": partial(_columns, OCCUPANCY_COLUMNS)})


def occupancy_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The occupancy changelog: both stateful steps, a row for every delta."""
    return _occupancy(spark, sf).outputs["changelog"]


def route_totals_state(spark: SparkSession, sf: str) -> DataFrame:
    """Occupancy of every route, read from the occupancy step's state stores."""
    return state_tables.route_totals(spark, _occupancy(spark, sf).checkpoint)


def vehicle_counts_state(spark: SparkSession, sf: str) -> DataFrame:
    """Last route and passenger count of every vehicle, read from state."""
    return state_tables.vehicle_counts(spark, _occupancy(spark, sf).checkpoint)


def occupancy_table(spark: SparkSession, sf: str) -> DataFrame:
    """Route occupancy as a table kept by the merge sink from the coalesced
    changelog: last value per route."""
    flow = jobs.occupancy_flow(jobs.delta_flow(_pings_by_time(spark, sf)), every_update=False, settings=S, split_routes=True)
    root = replay.new_folder(spark, "latest")
    rows = flow.select(*OCCUPANCY_COLUMNS)
    table = latest.LatestTable(spark, f"{root}/table", "routeId", ["timestamp", "eventId"], buckets=16)
    replay.run(partial(latest.start, rows, table, root.rsplit("/", 1)[1], checkpoint=f"{root}/checkpoint"), spark)
    last = _zoneless(table.read(), "timestamp")
    return last.withColumnRenamed("timestamp", "lastUpdated").drop("eventId")


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, int]:
    """Pings before and from the middle of their time span, and that instant
    in microseconds."""
    pings = load_locations(spark, sf)
    us = epoch_micros(pings, "timestamp")
    cut = pings.agg(F.min(us).alias("a"), F.max(us).alias("b")).selectExpr("(a + b) div 2 AS cut").first()["cut"] or 0
    return pings.filter(us < cut), pings.filter(us >= cut), cut


def _later(spark: SparkSession, later: DataFrame) -> DataFrame:
    later = replay.utc(later, "timestamp")
    return replay.record_stream(spark, replay.arrival_files(later, ["timestamp", "eventId"]), later)


def occupancy_handover(spark: SparkSession, sf: str) -> DataFrame:
    """The occupancy changelog of the later half of the pings, streamed on from
    the state that batch made of the earlier half."""
    history, later, _ = _halves(spark, sf)
    flow = handover.occupancy_flow(_later(spark, later), history, settings=S)
    return _replayed(spark, "handover", flow, {"changelog": partial(_columns, OCCUPANCY_COLUMNS)}).outputs["changelog"]


def offgrid_handover(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly alerts of the whole period: batch before the middle, stream on
    from there."""
    history, later, cut = _halves(spark, sf)
    tick_us = HOURLY.offgrid_check_interval_ms * 1000
    judged = (cut - 1) // tick_us
    flow = handover.offgrid_flow(_later(spark, later), history, judged, HOURLY)
    outputs = {"alerts": partial(event_offgrid.alerts, settings=HOURLY, ntz=True)}
    streamed = _replayed(spark, "handover", flow, outputs).outputs["alerts"]
    return offgrid.tick_alerts(history, from_epoch_micros(F.lit(judged * tick_us), True), HOURLY).unionByName(streamed)


def occupancy_by_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Route occupancy from stored summaries, extended part by part: the later
    half of the pings is added without reading the earlier half again."""
    history, later, _ = _halves(spark, sf)
    parts = increments.OccupancyParts(spark, replay.new_folder(spark, "parts"), S)
    parts.extend(1, history)
    parts.extend(2, later)
    return parts.occupancy()


REPLAYS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "revenue_replay": revenue_replay,
    "late_fares_replay": late_fares_replay,
    "open_windows_replay": open_windows_replay,
    "offgrid_replay": offgrid_replay,
    "last_seen_state": last_seen_state,
    "delta_replay": delta_replay,
    "occupancy_replay": occupancy_replay,
    "route_totals_state": route_totals_state,
    "vehicle_counts_state": vehicle_counts_state,
    "occupancy_table": occupancy_table,
    "occupancy_handover": occupancy_handover,
    "offgrid_handover": offgrid_handover,
    "occupancy_by_parts": occupancy_by_parts,
}
