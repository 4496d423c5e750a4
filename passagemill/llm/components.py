"""Connected components of an edge table, by alternating large and small stars.

Every round is two joins and two aggregations over the edges, written to the shared folder, so no group, component or
edge list meets in one task or the driver: a hub's minimum is combined before the shuffle, and its edges meet the one row
of the minimum in a join whose large partitions Spark splits. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.llm.shared import store


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (columns a, b); the component is its smallest node.

    Direction, repeated rows and loops do not matter; rows with a null end are left out; no edges give no rows.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = store(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _signature(edges)
    while True:
        edges = store(_small_star(store(_large_star(edges), "large_star")), "small_star")
        after = _signature(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    lower = edges.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.union(smallest.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
