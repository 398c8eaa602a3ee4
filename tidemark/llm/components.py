"""Connected components of a distributed edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def _print(edges: DataFrame) -> tuple:
    """Number of distinct edges and a fingerprint of them."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).head())


def connected(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of links (a, b): comp is the smallest node of its component.

    Each step links nodes to the smallest neighbour, so the stars grow in about log(nodes) rounds; every
    round ends in a written table.  A node's neighbours are never collected: only their minimum is.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = _print(edges)
    while True:
        # large star: every larger neighbour of u goes to the smallest of u's neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every smaller neighbour of u, and u, go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = written(small, "edges")
        now = _print(after)
        edges = after
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
