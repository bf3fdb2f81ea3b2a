"""Where search strategies disagree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.operators.clauses import Clause


def parity(docs: DataFrame, baseline: Clause, others: dict[str, Clause]) -> DataFrame:
    """Rows ``(strategy, hits, baseline_hits, only_baseline, only_strategy, same)``.

    All strategies are tested on the same row in one scan and only counts are shuffled: no
    join of key sets, and no limit that could hide a difference.
    """
    tests = docs.select(baseline.is_hit.alias("base"),
                        *[c.is_hit.alias(f"s{i}") for i, c in enumerate(others.values())])
    base = F.col("base")
    counts = [F.count_if(base).alias("base_n")]
    for i in range(len(others)):
        hit = F.col(f"s{i}")
        counts += [F.count_if(hit).alias(f"n{i}"), F.count_if(base & ~hit).alias(f"lost{i}"),
                   F.count_if(hit & ~base).alias(f"gained{i}")]
    rows = F.array(*[
        F.struct(F.lit(name).alias("strategy"), F.col(f"n{i}").alias("hits"),
                 F.col("base_n").alias("baseline_hits"), F.col(f"lost{i}").alias("only_baseline"),
                 F.col(f"gained{i}").alias("only_strategy"))
        for i, name in enumerate(others)])
    return tests.agg(*counts).select(F.inline(rows)).withColumn(
        "same", (F.col("only_baseline") == 0) & (F.col("only_strategy") == 0))


def compare_keys(left: DataFrame, right: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows ``(key, side)`` for keys on one side only; sets come from anywhere, such as an index."""
    ours = left.select(key).distinct().withColumn("in_left", F.lit(True))
    theirs = right.select(key).distinct().withColumn("in_right", F.lit(True))
    joined = ours.join(theirs, key, "full_outer")
    side = F.when(F.col("in_right").isNull(), "left").when(F.col("in_left").isNull(), "right")
    return joined.select(key, side.alias("side")).filter(F.col("side").isNotNull())


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that are not in ``right``, counting repeats."""
    return left.exceptAll(right)
