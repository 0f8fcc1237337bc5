"""Connected components of a graph of links, by alternating large and small stars.

Every step is a grouped minimum and a join, so links stay spread over the
cluster; a node with many links is split by the join (AQE), not gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.common import materialise
from sessionlens.operators.joins import join_per_key


def connected_components(links: DataFrame, files: int | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Each step's links are written to ``files`` files at most, if given.
    """
    links = materialise(links.filter(F.col("a") != F.col("b"))
                        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), files)
    before = None
    while True:
        large = _large_star(links)
        links = materialise(_small_star(large), files)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    # At rest every link leads from a node to its component's smallest.
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest among the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = join_per_key(both, least, "a", "inner").filter(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = join_per_key(links, least, "a", "inner")
    return (joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
