"""JSON records on the wire: keyed encode, decode with an explicit schema, and
the validity rules applied on decode (invalid rows are quarantined with a
reason instead of failing the job)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.scalar import is_blank
from fleetlens.schemas import FARE_EVENT, LOCATION_EVENT, PAYMENT_METHODS, PAYMENT_STATUSES

# Rejection messages of the record validity rules.
REASON_BLANK_MATATU = "matatuId must not be blank"
REASON_BLANK_ROUTE = "routeId must not be blank"
REASON_NEGATIVE_SPEED = "speedKmh must not be negative"
REASON_BAD_METHOD = "paymentMethod must be one of MPESA, CASH, CARD"
REASON_BAD_STATUS = "status must be one of SUCCESS, FAILED, PENDING"
REASON_MALFORMED = "malformed record"

_CORRUPT = "_corrupt_record"
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def with_ntz_timestamps(schema: T.StructType) -> T.StructType:
    """Same record schema with every timestamp as timestamp_ntz (batch replay)."""
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampNTZType(), f.nullable)
            if isinstance(f.dataType, T.TimestampType)
            else f
            for f in schema.fields
        ]
    )


def encode_keyed(df: DataFrame, key: str, fields: list[str], keep: list[str] = ()) -> DataFrame:
    """``(key, value)`` records: value is the JSON of ``fields``; ``keep``
    columns (e.g. an offset) ride along outside the payload."""
    value = F.to_json(
        F.struct(*fields),
        {"timestampFormat": ISO_INSTANT, "timestampNTZFormat": ISO_LOCAL},
    )
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"), *keep)


def decode(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Parse the JSON payload into top-level columns; keeps the other columns.

    A payload that is not valid JSON (or does not fit the schema) yields a
    row with ``_malformed`` true.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(value_col),
        with_corrupt,
        {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": _CORRUPT,
            "timestampNTZFormat": ISO_LOCAL,
        },
    )
    others = [c for c in df.columns if c != value_col]
    # ``inline(array(...))`` emits the parsed fields as columns through a
    # generator. Predicates on them (the validity split) cannot be pushed
    # below a generator, so each payload is parsed exactly once; a plain
    # projection would be inlined into every pushed-down predicate instead.
    null_record = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in with_corrupt.fields])
    rec = F.coalesce(parsed, null_record.withField(_CORRUPT, F.col(value_col).cast("string")))
    return (
        df.select(*others, F.inline(F.array(rec)))
        .withColumn("_malformed", F.col(_CORRUPT).isNotNull())
        .drop(_CORRUPT)
    )


def _first_reason(checks: list[tuple[Column, str]]) -> Column:
    out = None
    for cond, reason in checks:
        out = (F.when if out is None else out.when)(cond, F.lit(reason))
    return out


def location_reason(df: DataFrame) -> Column:
    """Null when the location record is valid, else why it is not."""
    checks = [
        (F.col("_malformed"), REASON_MALFORMED) if "_malformed" in df.columns else None,
        (is_blank(F.col("matatuId")), REASON_BLANK_MATATU),
        (is_blank(F.col("routeId")), REASON_BLANK_ROUTE),
        (F.col("speedKmh") < 0, REASON_NEGATIVE_SPEED),
    ]
    return _first_reason([c for c in checks if c is not None])


def fare_reason(df: DataFrame) -> Column:
    checks = [
        (F.col("_malformed"), REASON_MALFORMED) if "_malformed" in df.columns else None,
        (~F.coalesce(F.col("paymentMethod").isin(*PAYMENT_METHODS), F.lit(False)), REASON_BAD_METHOD),
        (~F.coalesce(F.col("status").isin(*PAYMENT_STATUSES), F.lit(False)), REASON_BAD_STATUS),
    ]
    return _first_reason([c for c in checks if c is not None])


def with_reason(df: DataFrame, kind: str) -> DataFrame:
    reason = location_reason(df) if kind == "location" else fare_reason(df)
    return df.withColumn("invalidReason", reason)


def split_valid(df: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with ``invalidReason``). One predicate,
    evaluated per branch; no extra shuffle."""
    tagged = with_reason(df, kind)
    drop = [c for c in ("_malformed",) if c in tagged.columns]
    valid = tagged.filter(F.col("invalidReason").isNull()).drop("invalidReason", *drop)
    if "passengersOnboard" in valid.columns:  # a count that is not given is 0
        valid = valid.withColumn("passengersOnboard", F.coalesce("passengersOnboard", F.lit(0)))
    quarantine = tagged.filter(F.col("invalidReason").isNotNull()).drop(*drop)
    return valid, quarantine


LOCATION_FIELDS = [f.name for f in LOCATION_EVENT.fields]
FARE_FIELDS = [f.name for f in FARE_EVENT.fields]
