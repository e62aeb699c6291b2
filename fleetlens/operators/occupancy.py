"""Passenger deltas per vehicle and clamped occupancy per route.

* :func:`passenger_deltas` (W1) - delta to the vehicle's previous ping (0 if
  none), boardings = max(0, d), alightings = max(0, -d); zero deltas kept.
* :func:`vehicle_snapshots` (A3) - latest ping per vehicle.
* :func:`occupancy_changelog` (W2) - one row per delta with the route's
  occupancy after the clamped fold ``x = max(0, x + d)`` and running totals.
* :func:`route_occupancy` (A2) - final occupancy per route.

The clamped fold is not a sum but has a closed form: with prefix sums S
(S_0 = 0), ``x_n = S_n - min(S_0..S_n)``. Over chunks it composes: a chunk
needs only the sum P of earlier deltas and the minimum M of earlier prefix
sums, both obtained from the per-chunk summary. So a route holding most of
the data is still folded in many parallel (route, chunk) tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.scalar import clamp_at_zero
from fleetlens.operators import scan
from fleetlens.operators.latest_row import latest_rows
from fleetlens.session import cut_lineage
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings

ORDER = ["timestamp", "eventId"]


def passenger_deltas(
    locations: DataFrame, settings: JobSettings = DEFAULT_SETTINGS, before: DataFrame | None = None
) -> DataFrame:
    """``before`` (matatuId, lastPassengerCount) holds the counts of vehicles
    whose earlier pings are not among ``locations``; it meets the edge rows of
    the scan only."""
    cols = ["matatuId", "routeId", "routeName", "passengersOnboard", "timestamp", "eventId"]
    rows = scan.with_cuts(locations.select(*cols), "matatuId", ORDER, settings.vehicle_chunk_seconds, settings)
    last = scan.chunk_edges(rows, ORDER, "last")
    carry = last.select(scan.KEY, scan.CHUNK, F.lag("_rec").over(scan.over_chunks()).alias("_carry"))
    rows = rows.withColumn("_prev", F.lag("passengersOnboard").over(scan.in_chunk(ORDER)))
    known = [F.col("_prev"), F.col("_carry.passengersOnboard")]
    if before is not None:
        counts = before.select(F.col("matatuId").alias(scan.KEY), F.col("lastPassengerCount").alias("_before"))
        carry = carry.join(counts, scan.KEY, "left")
        known.append(F.col("_before"))
    prev = F.coalesce(*known, F.lit(0))
    delta = (F.col("passengersOnboard") - prev).cast("int")
    return (
        scan.join_carry(rows, carry)
        .withColumn("passengerDelta", delta)
        .select(
            "matatuId",
            "routeId",
            "routeName",
            "passengerDelta",
            clamp_at_zero(F.col("passengerDelta")).alias("boardings"),
            clamp_at_zero(-F.col("passengerDelta")).alias("alightings"),
            "passengersOnboard",
            "timestamp",
            "eventId",
        )
    )


def vehicle_snapshots(locations: DataFrame) -> DataFrame:
    """Latest (routeId, passenger count, time) per vehicle; ties broken by
    eventId. Raw rows are hash-aggregated: see ``latest_row``."""
    last = latest_rows(locations, "matatuId", ["routeId"], ["passengersOnboard"])
    return last.select(
        "matatuId",
        "routeId",
        F.col("passengersOnboard").alias("lastPassengerCount"),
        F.col("timestamp").alias("lastUpdated"),
    )


def _route_chunks(deltas: DataFrame, settings: JobSettings) -> tuple[DataFrame, DataFrame]:
    """(rows with in-chunk running columns, per-chunk totals with carries)."""
    cols = ["routeId", "routeName", "passengerDelta", "boardings", "alightings", "matatuId", "timestamp", "eventId"]
    rows = scan.with_cuts(deltas.select(*cols), "routeId", ORDER, settings.scan_chunk_seconds, settings)
    w = scan.upto(scan.in_chunk(ORDER))
    rows = (
        rows.withColumn("_run_sum", F.sum("passengerDelta").over(w))
        .withColumn("_run_board", F.sum("boardings").over(w))
        .withColumn("_run_alight", F.sum("alightings").over(w))
        .withColumn("_run_min", F.min("_run_sum").over(w))
    )
    # running values of a chunk's last row are the chunk's totals
    rec = lambda c, alias: F.col(f"_rec.{c}").alias(alias)
    summary = scan.chunk_edges(rows, ORDER, "last").select(
        scan.KEY,
        rec("routeId", "routeId"),
        scan.CHUNK,
        rec("_run_sum", "_tot"),
        rec("_run_min", "_cmin"),
        rec("_run_board", "_tb"),
        rec("_run_alight", "_ta"),
        rec("routeName", "_name"),
        F.struct("_rec.timestamp", "_rec.eventId").alias("_lastKey"),
        "_rec",
    )
    prior = scan.before(scan.over_chunks())
    # "has an earlier chunk" asks for the whole earlier row: see scan.chunk_edges
    summary = summary.withColumn("_first", F.lag("_rec").over(scan.over_chunks()).isNull()).drop("_rec")
    since = lambda c: F.when(F.col("_first"), F.lit(0)).otherwise(F.sum(c).over(prior))
    summary = (
        summary.withColumn("_prior_sum", since("_tot"))
        .withColumn("_prior_board", since("_tb"))
        .withColumn("_prior_alight", since("_ta"))
        .withColumn("_low", F.col("_prior_sum") + F.col("_cmin"))
        .withColumn("_prior_min", F.least(F.lit(0), F.coalesce(F.min("_low").over(prior), F.lit(0))))
    )
    return rows, summary


def occupancy_changelog(
    deltas: DataFrame,
    settings: JobSettings = DEFAULT_SETTINGS,
    materialize: bool = False,
) -> DataFrame:
    """Route occupancy after every delta, in (timestamp, eventId) order.

    With ``materialize`` the deltas are first written as a table in the shared
    checkpoint folder, so a lost executor replays from there; that starts a
    job, so it is the caller's choice and needs ``spark.checkpoint.dir``.
    """
    if materialize:
        deltas = cut_lineage(deltas, "passenger_deltas")
    rows, summary = _route_chunks(deltas, settings)
    carry = summary.select(scan.KEY, scan.CHUNK, "_prior_sum", "_prior_board", "_prior_alight", "_prior_min")
    current = F.col("_prior_sum") + F.col("_run_sum") - F.least(F.col("_prior_min"), F.col("_prior_sum") + F.col("_run_min"))
    return scan.join_carry(rows, carry).select(
        "routeId",
        "routeName",
        current.cast("int").alias("currentPassengers"),
        (F.col("_prior_board") + F.col("_run_board")).cast("bigint").alias("totalBoardings"),
        (F.col("_prior_alight") + F.col("_run_alight")).cast("bigint").alias("totalAlightings"),
        "matatuId",
        "passengerDelta",
        "timestamp",
        "eventId",
    )


def chunk_summaries(deltas: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    """One row for each (route, chunk): what the chunk's deltas do to any
    occupancy, ``x -> tot + max(x, -low)`` in closed form, and their totals.
    Summaries of chunks compose, see :func:`composed`."""
    _, summary = _route_chunks(deltas, settings)
    return summary.select(
        "routeId", F.col(scan.CHUNK).alias("chunk"), F.col("_tot").alias("tot"), F.col("_cmin").alias("low"),
        F.col("_tb").alias("boardings"), F.col("_ta").alias("alightings"), F.col("_name").alias("routeName"),
        F.col("_lastKey.timestamp").alias("lastAt"), F.col("_lastKey.eventId").alias("lastId"),
    )


def composed(summaries: DataFrame, order: list[str]) -> DataFrame:
    """Occupancy of every route from its chunk summaries in ``order``."""
    prior = Window.partitionBy("routeId").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("tot").over(prior), F.lit(0))
    last = F.max_by(F.struct("routeName", "lastAt"), F.struct("lastAt", "lastId"))
    return (
        summaries.withColumn("_low", before + F.col("low"))
        .groupBy("routeId")
        .agg(F.sum("tot").alias("_sum"), F.min("_low").alias("_min"), F.sum("boardings").alias("totalBoardings"),
             F.sum("alightings").alias("totalAlightings"), last.alias("_last"))
        .select(
            "routeId", "_last.routeName",
            (F.col("_sum") - F.least(F.lit(0), F.col("_min"))).cast("int").alias("currentPassengers"),
            F.col("totalBoardings").cast("bigint").alias("totalBoardings"),
            F.col("totalAlightings").cast("bigint").alias("totalAlightings"), F.col("_last.lastAt").alias("lastUpdated"),
        )
    )


def route_occupancy(deltas: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Final occupancy per route, from the per-chunk summary alone."""
    _, summary = _route_chunks(deltas, settings)
    return (
        summary.groupBy(scan.KEY)
        .agg(
            F.max("routeId").alias("routeId"),
            F.sum("_tot").alias("_grand_sum"),
            F.min("_low").alias("_minlow"),
            F.sum("_tb").alias("totalBoardings"),
            F.sum("_ta").alias("totalAlightings"),
            F.max_by("_name", "_lastKey").alias("routeName"),
            F.max("_lastKey").alias("_k"),
        )
        .select(
            "routeId",
            "routeName",
            (F.col("_grand_sum") - F.least(F.lit(0), F.col("_minlow"))).cast("int").alias("currentPassengers"),
            F.col("totalBoardings").cast("bigint").alias("totalBoardings"),
            F.col("totalAlightings").cast("bigint").alias("totalAlightings"),
            F.col("_k.timestamp").alias("lastUpdated"),
        )
    )
