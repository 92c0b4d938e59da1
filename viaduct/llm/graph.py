"""Connected components as Spark joins, for edges of any number and any degree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, settle, spread_join


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (longs, a > b). Returns node, component (smallest node reachable) for every node of an edge.

    Alternating large-star and small-star steps: each node's neighbours are linked to the smallest of them, until
    every node hangs on its component's smallest one. A step only aggregates a minimum by node (with partial sums on
    the map side) and joins it back, the few nodes of very many edges by broadcast, so no node is ever gathered. Each
    step's edges are written to the shared folder, the last step's are then deleted; the driver sees one checksum a step.
    """
    now, before = settle(edges.select("a", "b").distinct(), "edges"), None
    while True:
        check = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if check == before:
            break
        before = check
        large = settle(large_star(now, check[0]), "large")
        discard(now)
        now = settle(small_star(large, check[0]), "small")
        discard(large)
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # (u = b, v = a) with v > u: link v to min(u)
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count(F.lit(1)).alias("size")).withColumnRenamed("a", "u")
    least = settle(least, "least")
    moved = spread_join(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), least, "u", "size", total)
    return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a > b").distinct()


def small_star(edges: DataFrame, total: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = settle(edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("size")), "least")
    moved = spread_join(edges, least, "a", "size", total).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return least.select("a", F.col("m").alias("b")).unionByName(moved).distinct()
