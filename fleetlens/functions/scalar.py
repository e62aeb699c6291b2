"""Scalar functions, all native Spark expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MASK31 = 2147483647

# Java ``String.hashCode() & Integer.MAX_VALUE`` as a higher-order expression.
# Java hashes UTF-16 units: a code point above U+FFFF counts as its surrogate
# pair (hi, lo), i.e. h*31*31 + hi*31 + lo. Masking each step to 31 bits is
# exact because the low 31 bits of h*31+x depend only on the low 31 bits of h;
# it also keeps every intermediate inside bigint under ANSI mode.
_JAVA_HASH_SQL = (
    "aggregate(transform(split({s}, ''), c -> cast(ascii(c) as bigint)), 0L, "
    "(h, x) -> CASE WHEN x < 65536 THEN (h * 31 + x) & {m}L "
    "ELSE (h * 961 + (55296 + ((x - 65536) >> 10)) * 31 "
    "+ (56320 + ((x - 65536) & 1023))) & {m}L END)"
)


def java_string_hash(col: str) -> Column:
    """Non-negative Java string hash (``hashCode() & 0x7fffffff``) as bigint."""
    return F.expr(_JAVA_HASH_SQL.format(s=f"`{col}`", m=_MASK31))


def clamp_at_zero(c: Column) -> Column:
    """``Math.max(0, c)``."""
    return F.greatest(F.lit(0), c)


def is_blank(c: Column) -> Column:
    """Null, empty or whitespace only (Java ``isBlank``)."""
    return c.isNull() | c.rlike(r"^\s*$")


def to_kes(c: Column) -> Column:
    """Money amount as ``decimal(18,2)``."""
    return c.cast(T.DecimalType(18, 2))


def _is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch for a timestamp or timestamp_ntz column.

    timestamp_ntz is read as a UTC wall time, independent of the session zone.
    """
    if _is_ntz(df, name):
        return F.expr(f"timestampdiff(MICROSECOND, {_NTZ_EPOCH}, `{name}`)")
    return F.unix_micros(F.col(name))


def floor_div(a: Column, b: int) -> Column:
    """Exact integer floor division of a bigint column by a positive int
    (``div`` on integers, no floating point; correct for negative values)."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b).cast("bigint"))


def ceil_div(a: Column, b: int) -> Column:
    return -floor_div(-a, b)


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds, floored (as ``Instant.toEpochMilli``)."""
    return floor_div(epoch_micros(df, name), 1000)


def from_epoch_micros(us: Column, ntz: bool) -> Column:
    """Inverse of :func:`epoch_micros`, producing the same timestamp flavour."""
    if ntz:
        return F.timestamp_add("MICROSECOND", us, F.expr(_NTZ_EPOCH))
    return F.timestamp_micros(us)


def millis_to_minutes(c: Column) -> Column:
    return floor_div(c, 60_000)


# The icon printed for each payment status.
STATUS_ICONS = {"SUCCESS": "✅", "FAILED": "❌", "PENDING": "⏳"}


def status_icon(c: Column) -> Column:
    expr = None
    for status, icon in STATUS_ICONS.items():
        expr = (F.when if expr is None else expr.when)(c == status, icon)
    return expr
