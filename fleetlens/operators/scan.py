"""Skew-safe ordered scans per key.

A plain ``Window.partitionBy(key).orderBy(t)`` sorts every row of a key in one
task; one vehicle, route or operator holding a third of the data would then
sit in a single task. Instead rows are split into (key, time chunk) groups:

1. the ordered window runs per (key, chunk) - bounded groups, many tasks;
2. the last (or first) row of every chunk, with the running values it holds,
   is scanned per key - keys x non-empty chunks rows. Choose the chunk width
   so that a chunk holds many rows of a key (``settings``): a day for a
   vehicle, a minute for a route or an operator;
3. the carry of earlier (or later) chunks is joined back on (key, chunk).
   The big side is already hash-partitioned on (key, chunk) by step 1, so only
   the edge rows move (AQE may broadcast them when they are measured small).

Steps 1 and 2 ask for the same columns of the same exchange, so Spark reads
and shuffles the source once (``ReusedExchange`` in the plan).

The chunk is a monotone function of the order column, so (chunk, order) gives
the same total order as (order) alone.

Chunks of clock time bound a group only as far as time spreads a key's rows. A
burst, a backfill stamped with one minute, would still meet in one task. With
``settings.scan_rows_per_range`` the chunks are ranges of rows instead
(:func:`with_ranges`): cut by quantiles of (key, order), whatever the times,
down to rows that are equal in all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.scalar import epoch_micros, floor_div
from fleetlens.session import cut_lineage
from fleetlens.settings import JobSettings

KEY = "_key"
CHUNK = "_chunk"
NO_KEY = "<none>"  # stands for a null key, which a valid record does not have
NO_TIME = -(1 << 63)  # chunk of rows without a time: before all others


def with_chunk(df: DataFrame, key: str, time_col: str, chunk_seconds: int) -> DataFrame:
    """Adds the scan's key and chunk. Both are never null: a join on them then
    adds no null filter below one side, which would spoil the shared exchange."""
    chunk = floor_div(epoch_micros(df, time_col), chunk_seconds * 1_000_000)
    return df.withColumn(KEY, F.coalesce(F.col(key), F.lit(NO_KEY))).withColumn(
        CHUNK, F.coalesce(chunk, F.lit(NO_TIME))
    )


def with_ranges(df: DataFrame, key: str, order: list[str], rows_per_range: int) -> DataFrame:
    """Adds the scan's key and, as its chunk, the number of the range of about
    ``rows_per_range`` rows that a row falls into.

    Rows are range-partitioned by (key, order) on sampled quantiles, so a key
    with very many rows goes over several ranges and a range holds several
    small keys. The ranges are written as a table in the shared folder: their
    numbers are then fixed, also for tasks that are tried again. Starts jobs
    (a count, and the write) and needs ``spark.checkpoint.dir``.
    """
    keyed = df.withColumn(KEY, F.coalesce(F.col(key), F.lit(NO_KEY)))
    ranges = max(1, -(-keyed.count() // rows_per_range))
    placed = keyed.repartitionByRange(ranges, KEY, *order).withColumn(CHUNK, F.spark_partition_id().cast("bigint"))
    return cut_lineage(placed, "ranges")


def with_cuts(df: DataFrame, key: str, order: list[str], chunk_seconds: int, settings: JobSettings) -> DataFrame:
    """The scan's key and chunk: ranges of rows if the settings ask for them,
    else chunks of ``chunk_seconds`` of the first ``order`` column."""
    if settings.scan_rows_per_range:
        return with_ranges(df, key, order, settings.scan_rows_per_range)
    return with_chunk(df, key, order[0], chunk_seconds)


def in_chunk(order: list[str]) -> Window:
    return Window.partitionBy(KEY, CHUNK).orderBy(*order)


def over_chunks() -> Window:
    return Window.partitionBy(KEY).orderBy(CHUNK)


def before(w: Window) -> Window:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def upto(w: Window) -> Window:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def chunk_edges(rows: DataFrame, order: list[str], edge: str) -> DataFrame:
    """(key, chunk, ``_rec``) with the ``last`` or ``first`` row of every
    non-empty (key, chunk); ``_rec`` is the whole row, running window columns
    included. Taking the whole row keeps this branch's columns those of the
    rows themselves, which is what lets Spark reuse their exchange.
    """
    beside = {"last": F.lead, "first": F.lag}[edge]
    flagged = rows.withColumn("_edge", beside(F.lit(1)).over(in_chunk(order)).isNull())
    return flagged.filter("_edge").select(KEY, CHUNK, F.struct(*rows.columns).alias("_rec"))


def join_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Left equi-join of the carry onto the rows on (key, chunk).

    Plain equality on the very columns the row windows are partitioned by:
    when the carry is too large to broadcast, the sort-merge join reuses the
    rows' existing (key, chunk) hash partitioning and only the carry moves.
    """
    return rows.join(carry, on=[KEY, CHUNK], how="left")
