"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage

ROUNDS = 60  # far more than the logarithm of any path length


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); the root is the smallest node of its component.

    Alternating large and small stars: every round hangs each node's larger neighbours, then its smaller ones, under the
    smallest. Neighbours are never gathered; each round is staged, and the loop ends when the edges stop changing.
    """
    edges = stage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(ROUNDS):
        two_way = _both(edges)
        least = two_way.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = two_way.join(least, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.filter("a <> b").distinct()  # a < b: b hangs under a
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        small = small.select(F.col("m").alias("a"), F.col("b")).unionByName(small.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()
        edges = stage(small, "edges")
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"edges still change after {ROUNDS} rounds")
    roots = edges.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
