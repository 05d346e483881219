"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clicktide.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour instead."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        near.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    down = edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (
        down.join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """Of every node of the edges (``u``, ``v``): ``node`` and ``root``, its component's smallest.

    Each round works on edges alone, written to the shared folder, and ends with stars
    only; rounds grow with the logarithm of the longest path. Only a count and a checksum
    of the edges reach the driver.
    """
    edges = written(edges.where(F.col("u") != F.col("v")).distinct(), "components")
    before = None
    while True:
        edges = written(_small_star(_large_star(edges)), "components")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
            ).distinct()
        before = now
