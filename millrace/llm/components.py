"""Connected components of a link table, by alternating star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the component's smallest node.

    The large star links each node's larger neighbours to its smallest one, the
    small star its smaller neighbours; both keep components as they are, and
    their alternation ends in a star around the smallest node after a number of
    rounds that is logarithmic in the longest path. Each round is written to
    the shared folder. The smallest neighbour is an aggregate that combines
    before the shuffle; no neighbour list is ever gathered. Loops and repeated
    links are allowed, nodes must not be null.
    """
    links = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        # Large star: every larger neighbour of a node is linked to the least of the node and its neighbours.
        both = _both(links)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node's smaller neighbours and the node itself are linked to the least of them.
        large = stage(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        links = stage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        state = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
