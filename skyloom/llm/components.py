"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); a component is named by its smallest node.

    Minima are summed up before they are shuffled, so a node with very many neighbours is no large group. Each step is
    a written table; only its count and checksum come to the driver. No edges give no rows; loops and repeated edges
    are ignored.
    """
    edges = saved(edges.where("u <> v").distinct(), "edges")
    mark = None
    while True:
        edges = saved(_small_star(_large_star(edges)), "edges")
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if seen["n"] == 0 or (seen["n"], seen["x"]) == mark:
            break
        mark = (seen["n"], seen["x"])
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
