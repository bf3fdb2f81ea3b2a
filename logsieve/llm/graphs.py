"""Connected components by alternating large and small stars, on tables of edges only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.llm.common import stored


def _pairs(edges: DataFrame) -> DataFrame:
    """Each edge once, as (a, b) with a > b."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node with an edge; the label is the smallest node of its component."""
    now, seen = stored(_pairs(edges), "edges"), None
    while True:
        sign = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())
        if sign == seen or not sign[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        now, seen = stored(_pairs(_small_star(_pairs(_large_star(now)))), "edges"), sign
