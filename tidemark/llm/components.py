"""Connected components of a large graph by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node moves to the smallest of its neighbourhood.
    Small star: every smaller neighbour, and the node itself, does."""
    around = _both_ways(edges) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    linked = around.join(lowest, F.col("a") == F.col("c"))
    if large:
        moved = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = lowest.select(F.col("c").alias("a"), F.col("m").alias("b"))
        moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges (a, b; longs): root is the smallest node reachable.

    Each round is written to the shared folder; rounds grow with the logarithm of the
    longest path. Self-links and repeated edges do no harm. No edges, no rows.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    state = None
    while True:
        now = staged(_star(_star(now, large=True), large=False), "components")
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
