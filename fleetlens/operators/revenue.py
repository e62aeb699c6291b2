"""Operator (sacco) revenue: tumbling event-time windows, grace, lateness.

* :func:`assign_operator` - the operator a fare's vehicle hashes to.
* :func:`windowed_revenue` - sum/count per (operator, window): one partial +
  final aggregate, so a hot operator or vehicle costs nothing extra and only
  operator-window sums are shuffled.
* :func:`late_fare_audit` - which fares a running stream would drop because
  their window had closed (window end + grace <= stream time) when they
  arrived. Stream time is the running maximum event time per operator in
  arrival order, computed as a chunked scan (see ``operators.scan``).
* :func:`emitted_revenue` - what the stream actually emits: late fares
  dropped, and only windows that have closed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.scalar import (
    epoch_micros,
    floor_div,
    from_epoch_micros,
    java_string_hash,
    to_kes,
)
from fleetlens.operators import scan
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings
from fleetlens.sources.dimension import SACCO_ROWS

# Fixed value: name used when an operator id has no dimension row.
UNKNOWN_OPERATOR_NAME = "Unknown SACCO"


def operator_keys(mode: str) -> list[tuple[str, str]]:
    """Sorted (key, name) pairs the fare hash indexes into.

    ``route``: the dimension is keyed by route id and those ids are what the
    running application emits as ``saccoId``. ``sacco``: the documented intent,
    keyed by sacco id.
    """
    if mode == "route":
        pairs = [(r, name) for r, _, name, _ in SACCO_ROWS]
    elif mode == "sacco":
        pairs = [(s, name) for _, s, name, _ in SACCO_ROWS]
    else:
        raise ValueError(f"unknown revenue key mode {mode!r}")
    return sorted(pairs)


def assign_operator(fares: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Adds ``saccoId``: sorted keys[(hash(matatuId) & 0x7fffffff) % n]."""
    keys = [k for k, _ in operator_keys(settings.revenue_key_mode)]
    idx = (java_string_hash("matatuId") % F.lit(len(keys)) + 1).cast("int")
    return fares.withColumn("saccoId", F.element_at(F.array(*[F.lit(k) for k in keys]), idx))


def operator_name(key: Column, settings: JobSettings = DEFAULT_SETTINGS) -> Column:
    """Name of an operator key. The key set is fixed (a handful of rows), so
    the lookup is a literal map: a broadcast with no join at all."""
    pairs = [x for k, n in operator_keys(settings.revenue_key_mode) for x in (F.lit(k), F.lit(n))]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(UNKNOWN_OPERATOR_NAME))


def successful(fares: DataFrame) -> DataFrame:
    return fares.filter(F.col("status") == "SUCCESS")


def windowed_revenue(
    fares: DataFrame, settings: JobSettings = DEFAULT_SETTINGS, time_col: str = "timestamp"
) -> DataFrame:
    """Sum and count of successful fares per (operator, tumbling window).

    The operator is hashed per fare, and each task sends one row per
    (operator, window): far fewer than per (vehicle, window), most of which
    hold a single fare.
    """
    win = F.window(time_col, f"{settings.revenue_window_minutes} minutes")
    agg = (
        assign_operator(successful(fares), settings)
        .groupBy("saccoId", win.alias("w"))
        .agg(F.sum("amountKes").alias("_total"), F.count(F.lit(1)).alias("transactionCount"))
    )
    return agg.select(
        "saccoId",
        operator_name(F.col("saccoId"), settings).alias("saccoName"),
        to_kes(F.col("_total")).alias("totalRevenueKes"),
        "transactionCount",
        F.col("w.start").alias("windowStart"),
        F.col("w.end").alias("windowEnd"),
    )


def late_fare_audit(
    fares: DataFrame,
    settings: JobSettings = DEFAULT_SETTINGS,
    time_col: str = "timestamp",
    arrival_col: str = "arrivalTs",
) -> DataFrame:
    """Every successful fare with its window, the stream time when it arrived,
    and ``isLate`` (window end + grace <= stream time)."""
    out = _audited(fares, settings, time_col, arrival_col, ["transactionId", "matatuId"])
    return out.select(
        "transactionId",
        "matatuId",
        "saccoId",
        "amountKes",
        F.col(time_col).alias("timestamp"),
        F.col(arrival_col).alias("arrivalTs"),
        "eventId",
        "windowStart",
        "windowEnd",
        "streamTime",
        "isLate",
    )


def _audited(
    fares: DataFrame, settings: JobSettings, time_col: str, arrival_col: str, keep: list[str]
) -> DataFrame:
    """The audit's columns for the fares' ``keep`` and its own fields; both
    scan branches carry exactly these, so they share one exchange."""
    order = [arrival_col, "eventId"]
    with_op = assign_operator(successful(fares), settings)
    ntz = with_op.schema[time_col].dataType.typeName() == "timestamp_ntz"
    cols = dict.fromkeys([*keep, "saccoId", "amountKes", time_col, arrival_col, "eventId"])
    with_op = with_op.select(*cols, epoch_micros(with_op, time_col).alias("_t"))
    rows = scan.with_cuts(with_op, "saccoId", order, settings.scan_chunk_seconds, settings)
    rows = rows.withColumn("_local_max", F.max("_t").over(scan.upto(scan.in_chunk(order))))
    last = scan.chunk_edges(rows, order, "last")
    carry = last.select(
        scan.KEY,
        scan.CHUNK,
        F.max(F.struct("_rec._local_max", "_rec")).over(scan.before(scan.over_chunks())).alias("_c"),
    ).select(scan.KEY, scan.CHUNK, F.col("_c._local_max").alias("_carry"))
    win_us = settings.revenue_window_ms * 1000
    grace_us = settings.revenue_grace_ms * 1000
    out = scan.join_carry(rows, carry)
    stream_us = F.greatest(F.col("_local_max"), F.coalesce("_carry", F.col("_local_max")))
    start_us = floor_div(F.col("_t"), win_us) * F.lit(win_us)
    return out.select(
        *cols,
        from_epoch_micros(start_us, ntz).alias("windowStart"),
        from_epoch_micros(start_us + F.lit(win_us), ntz).alias("windowEnd"),
        from_epoch_micros(stream_us, ntz).alias("streamTime"),
        (start_us + F.lit(win_us + grace_us) <= stream_us).alias("isLate"),
    )


def late_fares(fares: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    return late_fare_audit(fares, settings).filter("isLate").drop("isLate")


def emitted_revenue(fares: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    """Revenue as the stream emits it: fares that arrived after their window
    closed are dropped, and only closed windows (end + grace <= final stream
    time of the operator) are emitted, once."""
    audit = _audited(fares, settings, "timestamp", "arrivalTs", [])
    grace = F.expr(f"INTERVAL {settings.revenue_grace_minutes} MINUTES")
    # one row per operator and window: sums of the fares in time, and the
    # latest fare of all, which over the operator's windows is its final time
    agg = audit.groupBy("saccoId", "windowStart", "windowEnd").agg(
        F.sum(F.when(~F.col("isLate"), F.col("amountKes"))).alias("_total"),
        F.count_if(~F.col("isLate")).alias("transactionCount"),
        F.max("timestamp").alias("_latest"),
    )
    final = F.max("_latest").over(Window.partitionBy("saccoId").orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    ))
    return (
        agg.withColumn("_chunk", F.col("windowStart"))
        .withColumn("_final", final)
        .filter((F.col("windowEnd") + grace <= F.col("_final")) & (F.col("transactionCount") > 0))
        .select(
            "saccoId",
            operator_name(F.col("saccoId"), settings).alias("saccoName"),
            to_kes(F.col("_total")).alias("totalRevenueKes"),
            "transactionCount",
            "windowStart",
            "windowEnd",
        )
    )
