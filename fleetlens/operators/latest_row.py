"""The latest row of every key, hash-aggregated.

``max_by`` over a struct keeps a variable-width buffer, so Spark sorts every
raw row of a task by key before it aggregates. Here the raw rows go through a
hash aggregate: text columns are grouping columns, numbers and times are
``max_by`` values, and the order (time, then id) is one fixed-width number. The
few rows a key has then - one for each distinct text, a vehicle's routes - meet
in a second, small step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.scalar import epoch_micros

LOWEST = -(1 << 63)
_SPAN = "20000000000000000000BD"  # more than twice any id, as a decimal literal
ORDER_KEY = "_order"


def order_key(df: DataFrame, time_col: str = "timestamp", id_col: str = "eventId") -> Column:
    """(time, id) as one decimal of the same order; nulls come first."""
    us = F.coalesce(epoch_micros(df, time_col), F.lit(-(1 << 56))).cast("decimal(18,0)")
    own = F.coalesce(F.col(id_col), F.lit(LOWEST)).cast("decimal(19,0)")
    return (us * F.expr(_SPAN) + own).cast("decimal(38,0)")


def latest_rows(
    df: DataFrame, key: str, texts: list[str], numbers: list[str], time_col: str = "timestamp", id_col: str = "eventId"
) -> DataFrame:
    """``key``, ``texts``, ``numbers`` and ``time_col`` of the last row of each
    ``key`` by (``time_col``, ``id_col``); rows equal in both are one event."""
    fixed = [*numbers, time_col]
    rows = df.select(key, *texts, *fixed, order_key(df, time_col, id_col).alias(ORDER_KEY))
    by_text = rows.groupBy(key, *texts).agg(
        *[F.max_by(c, ORDER_KEY).alias(c) for c in fixed], F.max(ORDER_KEY).alias(ORDER_KEY)
    )
    # a number tells a key's rows apart, so the second maximum finds one of them
    last = by_text.groupBy(key).agg(F.max(ORDER_KEY).alias(ORDER_KEY))
    return by_text.join(last, (by_text[key].eqNullSafe(last[key])) & (by_text[ORDER_KEY] == last[ORDER_KEY]), "left_semi").select(
        key, *texts, *fixed
    )
