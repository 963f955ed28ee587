"""Connected components by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmetrics.llm.base import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """edges(a, b) of bigints -> (node, root): the smallest node reachable, for each node with an edge.

    A round hangs each node's larger neighbours, then its smaller ones, on the
    smallest of them. The edges end as stars around the roots. A node's
    neighbours are never gathered: their minimum is a combined aggregate, and
    the join back to the edges is one that adaptive execution can split.
    """
    edges = staged(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "stars")
    before, now = None, _state(edges)
    while now != before and now[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").unionByName(
            lowest.select("a", F.col("low").alias("b")))
        edges = staged(spark, small.distinct(), "stars")
        before, now = now, _state(edges)
    inner = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return inner.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
