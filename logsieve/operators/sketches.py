"""Stored quantile sketches: one for each name and day, merged over any period.

A sketch of some hundred numbers stands for all samples of a name on a day. Merged sketches are as good as one made of
all samples at once. A quantile from a sketch has a rank that is off by RANK_ERROR at most, with 99% probability; the
exact form is ``report.exact_percentiles``. Sketches draw lots, so that two of them may differ within that error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.sources.tables import source_state
from logsieve.sources.versions import Versions

# The size of a sketch, and the rank error of a quantile that goes with it (Karnin, Lang and Liberty, 2016).
SIZE, RANK_ERROR = 400, 0.01


def sketch_table(samples: DataFrame, name: str = "name", day: Column | str = "day", value: str = "ms", size: int = SIZE) -> DataFrame:
    """Rows ``(name, day, n, sketch)``; combined inside each task, so a name with most of the samples is as quick as any."""
    day = F.col(day) if isinstance(day, str) else day
    rows = samples.filter(F.col(value).isNotNull()).select(F.col(name).alias("name"), day.alias("day"), F.col(value).cast("double").alias("ms"))
    return rows.groupBy("name", "day").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("ms", F.lit(size)).alias("sketch"))


@dataclass(frozen=True)
class Sketches:
    rows: DataFrame  # name, day, n, sketch

    @staticmethod
    def ensure(samples: DataFrame, path: str, name: str = "name", day: Column | str = "day", value: str = "ms") -> "Sketches":
        """The newest version of the stored sketches if they were made from these samples as they are, else new ones."""
        spark = samples.sparkSession
        state = f"{name}, {value}, {SIZE}: {source_state(samples)}"
        folder = Versions(spark, path).ensure(state, lambda folder: sketch_table(samples, name, day, value).write.parquet(folder))
        return Sketches.load(spark, folder)

    @staticmethod
    def load(spark: SparkSession, folder: str) -> "Sketches":
        return Sketches(spark.read.parquet(folder))

    def quantiles(self, wanted: dict[str, float], first: str | None = None, last: str | None = None,
                  by: tuple[str, ...] = ("name",), period: Column | None = None) -> DataFrame:
        """``by, n`` and one column per quantile, over all days or those from ``first`` to ``last``.

        ``period``, an expression of the day such as its month, adds a column of that name.
        """
        rows = self.rows
        if first is not None:
            rows = rows.filter(F.col("day") >= F.lit(first).cast(rows.schema["day"].dataType))
        if last is not None:
            rows = rows.filter(F.col("day") <= F.lit(last).cast(rows.schema["day"].dataType))
        keys = [*by, *([period.alias("period")] if period is not None else [])]
        merged = rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SIZE)).alias("sketch"))
        shown = [*by, *(["period"] if period is not None else [])]
        return merged.select(*shown, "n", *[
            F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))).alias(name) for name, share in wanted.items()])
