"""Connected components of an edge table by alternating star operations.

Each round replaces the edges of every node by edges to the smallest node it
sees (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).
Rounds grow with the logarithm of the longest path; edges stay in tables, only
a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select(
        "a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with a > b: connects a's smaller neighbours to the smallest."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a")
    return moved.where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
        low.select("a", F.col("low").alias("b")))


def _digest(edges: DataFrame):
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """`edges(a, b)` of longs without nulls -> (node, root): for every node that has
    an edge to another node, the smallest node it can reach.  Loops and repeated
    edges do no harm; an empty table gives an empty table."""
    now = written(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = _digest(now)
    while before[0]:
        now = written(_small_star(_large_star(now)).distinct(), name)
        after = _digest(now)
        if after == before:
            break
        before = after
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
