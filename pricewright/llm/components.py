"""Connected components by alternating stars: no component is ever in one task as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the smallest node of its component.

    Each round links all neighbours of a node to the smallest of them: first the larger neighbours, then the
    smaller ones.  Every round is one shuffle over the links, which do not grow; rounds grow with the logarithm
    of the nodes.  Nodes must not be NULL; self-links are allowed and keep a node of its own.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # larger neighbours move to the smallest node next to them
        large = both.join(lowest, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.union(lowest.select("a", F.col("low").alias("b"))).distinct()
        # then the node and its smaller neighbours move to the smallest of these
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.greatest("b", "low").alias("a"), F.col("low").alias("b"))
        after = stored(small.union(low.select("a", F.col("low").alias("b"))).distinct())
        if after.join(edges, ["a", "b"], "left_anti").isEmpty() and edges.join(after, ["a", "b"], "left_anti").isEmpty():
            return after.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        edges = after
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
