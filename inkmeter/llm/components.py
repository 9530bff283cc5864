"""Connected components by alternating large-star and small-star steps.

Each step hooks the neighbours of a node to the smallest of them, and both
steps are one grouped minimum and one join, so a node with many neighbours is
an ordinary skewed key: the minimum combines map-side and adaptive execution
splits the join.  Every step is written to the shared folder.  The number of
steps grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmeter.llm.staging import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hook each larger neighbour of a node to the smallest around the node."""
    pairs = _both_ways(edges)
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (
        pairs.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hook each smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
        "a <> b"
    )
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    hooked = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return hooked.union(least.select("a", F.col("low").alias("b"))).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> node, root: the smallest node reachable, roots included."""
    edges = stage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = _state(edges)
    while True:
        edges = stage(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
