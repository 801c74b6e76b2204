"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them. ``edges`` run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    linked = edges.join(least, F.col("a") == F.col("u"))
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node that has an edge in (a, b).

    Each round is written to the shared folder, which ends its lineage; the number of rounds grows with the logarithm of the
    number of nodes. Only a count and a checksum reach the driver. Edges may repeat or run from a node to itself.
    """
    current = materialise(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges"
    )
    seen = None
    while True:
        # a sum that does not depend on the order of rows
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
        current = materialise(_small_star(_large_star(current)), "edges")
