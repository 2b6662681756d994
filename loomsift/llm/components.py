"""Connected components by alternating large-star and small-star steps.

Edges stay distributed; each step writes its result through ``checkpoint()``, so
the plan doesn't grow and a lost executor re-reads files. A star's centre may
have any number of neighbours: the minimum is a partially aggregated groupBy and
the join back is one that Spark may split when skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reclaim, shared_root


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour to the least of the closed neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node's smaller neighbours, and itself, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .where("a > b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its
    least node. Self-links name a node without linking it."""
    shared_root(edges.sparkSession)
    edges = edges.select("a", "b").checkpoint()
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    stars = edges.where("a <> b")
    before = None
    while True:
        stars = _small_star(_large_star(stars)).checkpoint()
        reclaim(edges.sparkSession)  # shuffles of the last step, and what it read
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return nodes.join(stars, nodes.node == stars.a, "left").select("node", F.coalesce("b", "node").alias("component"))
