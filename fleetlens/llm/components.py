"""Connected components of an edge table by alternating large and small stars.

Every step is a grouped minimum (pre-aggregated before its shuffle) and an
equality join that AQE splits where a node has very many edges. The edge table
is written to the shared folder after each round, so lineage stays short; only
a count and a checksum of it reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b: comparable ids) -> (node, component); component is the
    smallest node reachable. Nodes without an edge to another do not appear.
    """
    cur = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    mark = None
    for _ in range(max_rounds):
        now = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark or now[0] == 0:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                cur.select(F.col("b").alias("node"), F.col("b").alias("component"))
            ).distinct()
        mark = now
        before, cur = cur, written(_small_star(_large_star(cur)), "edges")
        discard(before)
    raise RuntimeError(f"components not stable after {max_rounds} rounds")


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return (
        both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    )


def _small_star(e: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = e.groupBy("a").agg(F.min("b").alias("low"))
    rest = e.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return rest.union(low.select("a", F.col("low").alias("b"))).distinct()
