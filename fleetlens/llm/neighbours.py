"""Rows in ascending id order, each beside its successor, without a global
window: ids are cut into ranges by quantiles, every range is one sorted run,
and the first row of a range also travels to the range before it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE, AHEAD = "_range", "_ahead"


def _at_or_below(bounds: list[int], x: Column) -> Column:
    """How many of the sorted ``bounds`` are at or below ``x``: a search in
    every w-th bound, then in the w bounds that follow it (w: square root)."""
    if not bounds:
        return F.lit(0)
    w = math.isqrt(len(bounds)) + 1
    parts = [bounds[i : i + w] for i in range(0, len(bounds), w)]
    heads = F.array(*[F.lit(part[0]) for part in parts])
    cells = F.array(*[F.array(*[F.lit(b) for b in part]) for part in parts])
    c = F.size(F.filter(heads, lambda b: b <= x))
    inside = F.size(F.filter(F.element_at(cells, F.greatest(c, F.lit(1))), lambda b: b <= x))
    return F.when(c == 0, F.lit(0)).otherwise((c - 1) * w + inside)


def ranged(df: DataFrame, id_col: str, ranges: int) -> tuple[DataFrame, int]:
    """``df`` with ``_range`` (see :func:`runs` for its order). A copy of the first row of each non-empty
    range stands at the end of the one before (``_ahead`` true); the very
    first row's copy ends the last range.

    Null ids sort first. Only the range bounds (``ranges`` numbers) and each
    range's smallest id reach the driver. Rows of one repeated id share a
    range.
    """
    points = [i / ranges for i in range(1, ranges)]
    bounds = []
    if points:
        bounds = sorted(set(df.agg(F.percentile_approx(id_col, points).alias("q")).first()["q"] or []))
    order = F.coalesce(F.col(id_col), F.lit(-(1 << 63)))
    at = _at_or_below(bounds, order)
    tagged = df.withColumn(RANGE, at.cast("int"))
    first = {
        r[RANGE]: r["low"]
        for r in tagged.groupBy(RANGE).agg(F.min(order).alias("low")).collect()
    }
    used = sorted(first)
    if not used:
        return tagged.withColumn(AHEAD, F.lit(False)), 0
    before = {r: used[i - 1] for i, r in enumerate(used)}  # the first range follows the last
    lows = F.create_map(*[F.lit(x) for r in used for x in (r, int(first[r]))])
    prev = F.create_map(*[F.lit(x) for r in used for x in (r, before[r])])
    is_first = order == lows[F.col(RANGE)]
    homes = F.when(
        is_first,
        F.array(
            F.struct(F.col(RANGE), F.lit(False).alias(AHEAD)),
            F.struct(prev[F.col(RANGE)].alias(RANGE), F.lit(True).alias(AHEAD)),
        ),
    ).otherwise(F.array(F.struct(F.col(RANGE), F.lit(False).alias(AHEAD))))
    rows = tagged.withColumn("_homes", homes).drop(RANGE).select("*", F.inline("_homes")).drop("_homes")
    return rows, len(used)


def runs(rows: DataFrame, id_col: str, *ties: str) -> DataFrame:
    """Ranges as sorted runs, several to a task; within a range by id, equal
    ids by ``ties``; the copied successor last."""
    return rows.repartition(RANGE).sortWithinPartitions(RANGE, AHEAD, id_col, *ties)
