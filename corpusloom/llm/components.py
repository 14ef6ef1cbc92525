"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.scratch import settle


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` (longs), root being the smallest reachable node.

    Each round turns every node's larger neighbours, then its smaller ones, towards the smallest it
    sees; the number of rounds grows with the logarithm of the longest path. Minima are
    partial aggregates, and joins run on written tables, so that a node with many neighbours can be
    split. The driver sees one count and one checksum a round.
    """
    edges = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))
        large = settle(both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        lowest = settle(large.groupBy("a").agg(F.min("b").alias("low")))
        small = large.join(lowest, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = settle(small.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct())
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
