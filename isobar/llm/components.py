"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import checkpointed


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b of one ordered type); root is the component's least node.

    Both steps keep the components and turn each neighbourhood into a star
    around its least node, so the number of rounds grows with the logarithm of
    the longest path. Nothing but two numbers a round comes to the driver. No
    edges give no rows; loops and null ends are ignored. Each least neighbour
    is written before it is joined, so a node with very many edges is split
    between tasks.
    """
    ends = F.struct(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = edges.where("a <> b").select(ends.alias("e")).select("e.*").distinct()
    current, before = checkpointed(pairs), None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(current.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
        before = state
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(_minima(both).withColumn("m", F.least("u", "m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = checkpointed(large)
        small = large.join(_minima(large), "u")
        current = checkpointed(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).distinct())
