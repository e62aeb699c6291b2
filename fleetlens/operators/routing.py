"""Fare status routing: a first-match-wins split into exactly one branch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.scalar import to_kes

# Branch order (first match wins) and branch labels.
BRANCHES = (("failed", "FAILED"), ("success", "SUCCESS"))
DEFAULT_BRANCH = "default"


def label_branches(fares: DataFrame) -> DataFrame:
    """Each fare with its ``branch`` label: failed, success or default."""
    label = None
    for name, status in BRANCHES:
        label = (F.when if label is None else label.when)(F.col("status") == status, name)
    return fares.withColumn("branch", label.otherwise(DEFAULT_BRANCH))


def split_branches(fares: DataFrame) -> dict[str, DataFrame]:
    """One filtered DataFrame per branch; the label is computed once per row."""
    labelled = label_branches(fares)
    names = [n for n, _ in BRANCHES] + [DEFAULT_BRANCH]
    return {n: labelled.filter(F.col("branch") == n).drop("branch") for n in names}


def failed_fares(fares: DataFrame) -> DataFrame:
    """The only branch that is published downstream."""
    return split_branches(fares)["failed"]


def branch_summary(fares: DataFrame) -> DataFrame:
    """Per-branch counts and amounts (the batch form of the per-branch taps)."""
    return (
        label_branches(fares)
        .groupBy("branch")
        .agg(
            F.count(F.lit(1)).alias("fares"),
            to_kes(F.sum("amountKes")).alias("amountKes"),
        )
    )


def observe_branches(fares: DataFrame, name: str = "fare_branches") -> DataFrame:
    """Attach per-branch counters as observed metrics (the batch/stream form
    of the per-branch log taps). Values appear in ``StreamingQueryProgress``
    ``observedMetrics`` for streams and in an ``Observation`` for batch."""
    return fares.observe(
        name,
        *[
            F.sum(F.when(F.col("status") == status, 1).otherwise(0)).alias(label)
            for label, status in BRANCHES
        ],
        F.sum(F.when(~F.col("status").isin(*[s for _, s in BRANCHES]), 1).otherwise(0)).alias(
            DEFAULT_BRANCH
        ),
    )
