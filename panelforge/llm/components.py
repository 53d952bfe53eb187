"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import written


def _weight(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r.n, int(r.h or 0)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component = smallest node reachable.

    Alternating large-star and small-star steps: every step points the
    neighbours of a node at the smallest of them, so the graph shrinks to stars
    in a number of rounds that grows with the logarithm of its size. Each step
    is an aggregate (combined before the shuffle) and an equi-join; every round
    is written to the shared folder. Self-loops are allowed.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    before = _weight(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(smallest, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # a node that is smaller than all its neighbours keeps its edges; the others pass them to the smallest
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = written(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "components")
        weight = _weight(after)
        edges = after
        if weight == before:
            break
        before = weight
    # both ends of a star: the centre is its own component
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
