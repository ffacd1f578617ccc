"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def connected_components(links: DataFrame, name: str) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of ``links(a, b)``.

    Each round hooks every node's neighbours to its smallest one; stars are reached
    after a number of rounds logarithmic in the longest path. Rounds are written to
    shared storage; the driver sees one checksum a round.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, f"{name}-links")
    seen = None
    while True:
        # Large star: a node's larger neighbours go to its smallest neighbour (or itself).
        near = _both_ways(edges)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours go to the smallest of these.
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        edges = stored(small.where("a <> b").distinct(), f"{name}-stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    # A star's centre is the least of its component; at the fixed point each node has one.
    leaves = edges.groupBy("a").agg(F.min("b").alias("component"))
    centres = leaves.select(F.col("component").alias("node"), "component").distinct()
    return leaves.withColumnRenamed("a", "node").unionByName(centres)
