"""Counts of matching documents per value of a field, with the total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.operators.clauses import Clause
from logsieve.operators.search import hits


def facet(docs: DataFrame, clause: Clause, path: str) -> DataFrame:
    """Rows ``(bucket, is_total, n)``: one per value of ``path`` and one for all hits.

    Hits are counted per value inside each task before anything is shuffled, so a value that
    holds most of the hits costs one row per task. The total is added up from these counts
    and not from the hits; it includes hits without a value, which have no bucket.
    """
    counts = (hits(docs, clause).groupBy(F.col(path).alias("bucket"))
              .agg(F.count(F.lit(1)).alias("n")))
    summed = counts.rollup("bucket").agg(
        F.sum("n").alias("n"), (F.grouping("bucket") == 1).alias("is_total"))
    rows = summed.filter(F.col("is_total") | F.col("bucket").isNotNull())
    return rows.select("bucket", "is_total", F.coalesce("n", F.lit(0)).alias("n"))


def ordered(rows: DataFrame) -> DataFrame:
    """The total first, then the buckets by count, ties by name."""
    return rows.orderBy(F.desc("is_total"), F.desc("n"), F.asc("bucket"))
