"""Static route -> operator (sacco) dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.schemas import SACCO_INFO

# The route -> operator dimension (routeId, saccoId, saccoName,
# terminus). route_99 is deliberately absent (an unknown route).
SACCO_ROWS = (
    ("route_33", "sacco_01", "Citi Hoppa", "Kikuyu Town"),
    ("route_23", "sacco_02", "KBS", "Westlands"),
    ("route_58", "sacco_03", "Double M", "Kawangware"),
    ("route_111", "sacco_04", "Metro Trans", "Rongai"),
    ("route_46", "sacco_05", "Forward Travellers", "Eastleigh"),
)

# What a lookup miss resolves to.
UNKNOWN_SACCO = ("unknown", "Unknown Sacco", "Unknown Terminus")


def sacco_dim(spark: SparkSession) -> DataFrame:
    """The dimension as a DataFrame. Its size is fixed by construction."""
    return spark.createDataFrame(list(SACCO_ROWS), SACCO_INFO)

