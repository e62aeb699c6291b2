"""Per-record log lines of the flows, as message columns (P8).

The application logs one line per record at several points; here each line
is a ``message`` column built with ``format_string`` (JVM-side), so it can be
written, filtered or counted like any other column. Values print as Java
prints them: doubles via ``cast(string)`` (Java ``Double.toString``),
decimals as plain strings, instants as ISO-8601 with a ``Z`` suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.scalar import epoch_micros, millis_to_minutes
from fleetlens.settings import DEFAULT_SETTINGS, JobSettings

# The log line formats, one per tap.
SPEED_ALERT = "[SPEED ALERT]  Matatu %s on %s doing %s km/h (threshold: %s km/h)"
ENRICHED = "[ENRICHMENT] ✅ %s on %s (%s) enriched with SACCO: %s"
NO_SACCO = "[ENRICHMENT] ⚠️ No SACCO found for routeId='%s' on matatu '%s'"
FARE_FAILED = "[FARES] ❌ Failed payment → txn=%s, matatu=%s, amount=KES %s, method=%s"
FARE_SUCCESS = "[FARES] ✅ Success → txn=%s, matatu=%s, amount=KES %s, method=%s"
FARE_PENDING = "[FARES] ⏳ Pending → txn=%s, matatu=%s"
FARE_LOG = "[FARES] %s Payment → txn=%s, matatu=%s, amount=KES %s, method=%s, status=%s"
LOCATION_LOG = "[LOGGER] 📝 Persisting → matatu=%s, route=%s, lat=%s, lng=%s, speed=%s, offset=%s"
DELTA = "[DELTA] 🚌 %s | prev=%s cur=%s delta=%s"
OCCUPANCY = "[OCCUPANCY] 🚌 Route %s | On board: %s | Boarded: %s | Alighted: %s"
REVENUE = "[REVENUE] 💰 SACCO: %s | Window: %s → %s | Total: KES %s | Transactions: %s"
OFF_GRID = "[OFF-GRID] 📡 Matatu %s on %s has been silent for %s minutes. Last seen: %s"


def _s(name: str) -> Column:
    return F.col(name).cast("string")


def instant_string(df: DataFrame, name: str) -> Column:
    """ISO-8601 instant as Java prints it: seconds, then .SSS or .SSSSSS
    only when the fraction needs it, then ``Z``."""
    frac = F.pmod(epoch_micros(df, name), F.lit(1_000_000))
    base = "yyyy-MM-dd'T'HH:mm:ss"
    return (
        F.when(frac == 0, F.date_format(name, base + "'Z'"))
        .when(F.pmod(frac, F.lit(1000)) == 0, F.date_format(name, base + ".SSS'Z'"))
        .otherwise(F.date_format(name, base + ".SSSSSS'Z'"))
    )


def speed_alert_messages(alerts: DataFrame, settings: JobSettings = DEFAULT_SETTINGS) -> DataFrame:
    return alerts.withColumn(
        "message",
        F.format_string(
            SPEED_ALERT,
            F.col("matatuId"),
            F.col("routeName"),
            _s("speedKmh"),
            F.lit(str(float(settings.speed_threshold_kmh))),
        ),
    )


def enrichment_messages(enriched: DataFrame) -> DataFrame:
    """Debug line per enriched ping; the warning line for unknown routes."""
    return enriched.withColumn(
        "message",
        F.when(
            F.col("saccoId") == "unknown",
            F.format_string(NO_SACCO, F.col("routeId"), F.col("matatuId")),
        ).otherwise(
            F.format_string(
                ENRICHED, F.col("matatuId"), F.col("routeName"), F.col("routeId"), F.col("saccoName")
            )
        ),
    )


def fare_branch_messages(labelled: DataFrame) -> DataFrame:
    """Line logged by each fare branch (``branch`` from routing)."""
    amount = _s("amountKes")
    return labelled.withColumn(
        "message",
        F.when(
            F.col("branch") == "failed",
            F.format_string(FARE_FAILED, F.col("transactionId"), F.col("matatuId"), amount, F.col("paymentMethod")),
        )
        .when(
            F.col("branch") == "success",
            F.format_string(FARE_SUCCESS, F.col("transactionId"), F.col("matatuId"), amount, F.col("paymentMethod")),
        )
        .otherwise(F.format_string(FARE_PENDING, F.col("transactionId"), F.col("matatuId"))),
    )


def fare_log_message(icon: Column) -> Column:
    return F.format_string(
        FARE_LOG,
        icon,
        F.col("transactionId"),
        F.col("matatuId"),
        _s("amountKes"),
        F.col("paymentMethod"),
        F.col("status"),
    )


def location_log_messages(locations: DataFrame, offset_col: str = "eventId") -> DataFrame:
    return locations.withColumn(
        "message",
        F.format_string(
            LOCATION_LOG,
            F.col("matatuId"),
            F.col("routeId"),
            _s("latitude"),
            _s("longitude"),
            _s("speedKmh"),
            _s(offset_col),
        ),
    )


def delta_messages(deltas: DataFrame) -> DataFrame:
    prev = F.col("passengersOnboard") - F.col("passengerDelta")
    return deltas.withColumn(
        "message",
        F.format_string(
            DELTA, F.col("matatuId"), prev.cast("string"), _s("passengersOnboard"), _s("passengerDelta")
        ),
    )


def occupancy_messages(changelog: DataFrame) -> DataFrame:
    return changelog.withColumn(
        "message",
        F.format_string(
            OCCUPANCY,
            F.col("routeId"),
            _s("currentPassengers"),
            _s("totalBoardings"),
            _s("totalAlightings"),
        ),
    )


def revenue_messages(revenue: DataFrame) -> DataFrame:
    return revenue.withColumn(
        "message",
        F.format_string(
            REVENUE,
            F.col("saccoName"),
            instant_string(revenue, "windowStart"),
            instant_string(revenue, "windowEnd"),
            _s("totalRevenueKes"),
            _s("transactionCount"),
        ),
    )


# The line before and after the minutes: the same for all alerts of a gap.
_OFF_GRID_HEAD, _OFF_GRID_TAIL = (lambda parts: ("%s".join(parts[:3]), "%s".join(parts[3:])))(OFF_GRID.split("%s"))

OFF_GRID_PARTS = {
    "_head": lambda gaps: F.format_string(_OFF_GRID_HEAD, F.col("matatuId"), F.col("routeName")),
    "_tail": lambda gaps: F.format_string(_OFF_GRID_TAIL, instant_string(gaps, "lastSeenAt")),
}


def offgrid_messages(alerts: DataFrame) -> DataFrame:
    """The line of every alert; alerts with the parts of their gap
    (``OFF_GRID_PARTS``) only add the minutes."""
    minutes = millis_to_minutes(F.col("silenceDurationMs")).cast("string")
    if set(OFF_GRID_PARTS) <= set(alerts.columns):
        return alerts.withColumn("message", F.concat("_head", minutes, "_tail")).drop(*OFF_GRID_PARTS)
    return alerts.withColumn(
        "message",
        F.format_string(
            OFF_GRID,
            F.col("matatuId"),
            F.col("routeName"),
            millis_to_minutes(F.col("silenceDurationMs")).cast("string"),
            instant_string(alerts, "lastSeenAt"),
        ),
    )
