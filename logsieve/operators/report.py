"""Latency reports: summaries, winners, percentiles and report sections.

Samples are rows ``(..., method, ms)``. A group may hold most of the samples, so sums are
combined inside each task, and percentiles are found without gathering a group in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Distinct values up to which a group's percentiles are taken from one count of its values, and buckets into which the
# values of larger groups are split; a power of two.
DISTINCT, BUCKETS = 100_000, 256


def slot_means(samples: DataFrame, by: Sequence[str] = ("label", "method", "slot"),
               value: str = "ms") -> DataFrame:
    """Mean of the queries run in one timed slot: the first of two levels."""
    return samples.groupBy(*by).agg(F.avg(value).alias(value))


def latency_summary(samples: DataFrame, by: Sequence[str] = ("label", "method"),
                    value: str = "ms") -> DataFrame:
    """``avg, median, min, max, stdev, n`` per group; the sample deviation of one value is 0.

    Groups of up to DISTINCT different values, which are nearly all, take one aggregation.
    """
    def plain(rows: DataFrame, *more: Column) -> DataFrame:
        return rows.groupBy(*by).agg(
            F.avg(value).alias("avg"), F.min(value).alias("min"), F.max(value).alias("max"),
            F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("stdev"), F.count(value).alias("n"), *more)

    small, large = _by_size(samples, by, value)
    found = plain(small, F.percentile(value, F.lit(0.5)).alias("median"))
    columns = (*by, "avg", "median", "min", "max", "stdev", "n")
    if large is None:
        return found.select(*columns)
    middle = _bucketed_percentiles(large, by, value, {"median": 0.5})
    return found.select(*columns).unionByName(_matched(plain(large), middle, by, "left").select(*columns))


def _by_size(samples: DataFrame, by: Sequence[str], value: str) -> tuple[DataFrame, DataFrame | None]:
    """Samples of groups with few different values, and those of the others, if there are any: one pass that moves a sketch per group."""
    sizes = samples.groupBy(*by).agg(F.approx_count_distinct(value).alias("_distinct")).filter(F.col("_distinct") > DISTINCT)
    if sizes.isEmpty():
        return samples, None
    wide = sizes.select(*[F.col(c).alias(f"_wide_{c}") for c in by])
    test = F.lit(True)
    for c in by:
        test = test & F.col(c).eqNullSafe(F.col(f"_wide_{c}"))
    return samples.join(wide, test, "left_anti"), samples.join(wide, test, "left_semi")


def exact_percentiles(samples: DataFrame, by: Sequence[str], value: str,
                      wanted: dict[str, float]) -> DataFrame:
    """One column per wanted percentile, interpolated linearly, exact at any group size.

    Groups of up to DISTINCT different values are counted by value in one aggregation, combined
    inside each task; what a task holds is bounded by that number. Larger ones go by buckets.
    """
    present = samples.filter(F.col(value).isNotNull())
    small, large = _by_size(present, by, value)
    found = small.groupBy(*by).agg(F.percentile(value, F.array(*[F.lit(float(p)) for p in wanted.values()])).alias("_found"))
    found = found.select(*by, *[F.col("_found")[i].alias(name) for i, name in enumerate(wanted)])
    return found if large is None else found.unionByName(_bucketed_percentiles(large, by, value, wanted))


def _bucketed_percentiles(samples: DataFrame, by: Sequence[str], value: str,
                          wanted: dict[str, float]) -> DataFrame:
    """Percentiles of groups of any size: no group is gathered in one place.

    Equal values are counted first. The distinct values of
    each group are then cut into buckets of about equal size, whatever their spread, at
    approximate quantiles. Bucket counts, at most BUCKETS rows per group, tell which buckets hold
    the wanted ranks, and only the values of those buckets are put in order, each by itself.
    """
    by = list(by)
    counted = (samples.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v"))
               .agg(F.count(F.lit(1)).alias("n")))
    cuts = F.percentile_approx("v", [i / BUCKETS for i in range(1, BUCKETS)], 20 * BUCKETS)
    span = counted.groupBy(*by).agg(cuts.alias("cuts"), F.sum("n").alias("total"))
    placed = _matched(counted, span, by).select(*by, "v", "n", "total", _bucket(F.col("v"), F.col("cuts")).alias("bucket"))

    sizes = placed.groupBy(*by, "bucket").agg(F.sum("n").alias("held"), F.max("total").alias("total"))
    up_to = Window.partitionBy(*by).orderBy("bucket")
    ranked = sizes.withColumn("before", F.sum("held").over(up_to) - F.col("held"))
    ranks = _ranks(F.col("total"), wanted)
    ranked = ranked.withColumn("ranks", F.filter(
        F.array_distinct(F.array(*[r for pair in ranks.values() for r in pair])),
        lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("held"))))
    needed = ranked.filter(F.size("ranks") > 0).select(*by, "bucket", "before", "ranks", "total")

    keys = [*by, "bucket"]
    rows = _matched(placed.drop("total"), needed, keys)
    in_order = Window.partitionBy(*keys).orderBy("v")
    last = F.col("before") + F.sum("n").over(in_order)
    rows = rows.withColumn("last", last).withColumn("first", F.col("last") - F.col("n"))
    at_rank = rows.select(*by, "v", "total", F.explode(F.filter(
        "ranks", lambda r: (r >= F.col("first")) & (r < F.col("last")))).alias("rank"))

    picked = []
    ranks = _ranks(F.col("total"), wanted)
    for name, (low, high) in ranks.items():
        picked += [F.max(F.when(F.col("rank") == low, F.col("v"))).alias(f"{name}_low"),
                   F.max(F.when(F.col("rank") == high, F.col("v"))).alias(f"{name}_high")]
    found = at_rank.groupBy(*by).agg(F.max("total").alias("total"), *picked)
    return found.select(*by, *[
        _between(F.col(f"{name}_low"), F.col(f"{name}_high"), F.col("total"), share).alias(name)
        for name, share in wanted.items()])


def _matched(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on group columns; a missing group value is a group like any other."""
    renamed = right.withColumnsRenamed({c: f"right_{c}" for c in columns})
    test = F.lit(True)
    for c in columns:
        test = test & F.col(c).eqNullSafe(F.col(f"right_{c}"))
    return left.join(renamed, test, how).drop(*[f"right_{c}" for c in columns])


def _bucket(value: Column, cuts: Column) -> Column:
    """How many of the ascending cuts are below the value, by halving."""
    steps = F.array(*[F.lit(BUCKETS >> i) for i in range(1, BUCKETS.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at))


def _position(total: Column, share: float) -> Column:
    return F.lit(float(share)) * (total - 1)


def _ranks(total: Column, wanted: dict[str, float]) -> dict[str, tuple[Column, Column]]:
    """Ranks, from 0, of the two values around each percentile."""
    return {name: (F.floor(_position(total, share)), F.ceil(_position(total, share)))
            for name, share in wanted.items()}


def _between(low: Column, high: Column, total: Column, share: float) -> Column:
    position = _position(total, share)
    return low + (high - low) * (position - F.floor(position))


def percentiles(samples: DataFrame, by: Sequence[str] = ("name",), value: str = "ms") -> DataFrame:
    """P50, P95 and P99 per request name."""
    return exact_percentiles(samples, by, value, {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def winners(summary: DataFrame, by: Sequence[str] = ("label",)) -> DataFrame:
    """The method with the smallest average, and how many times faster it is than the slowest."""
    best = summary.groupBy(*by).agg(
        F.min_by("method", F.struct("avg", "method")).alias("winner"),
        F.min("avg").alias("fastest"), F.max("avg").alias("slowest"))
    factor = F.when(F.col("fastest") == 0, F.lit(float("inf"))).otherwise(
        F.col("slowest") / F.nullif(F.col("fastest"), F.lit(0.0)))
    return best.select(*by, "winner", factor.alias("factor"))


def section(limit: Column, negation: Column) -> Column:
    """Report section of a result: negation, dense (a limited fetch) or selective (all hits)."""
    return (F.when(negation, "negation").when(limit != 0, "dense").otherwise("selective"))


def shown(value: Column, digits: int = 1) -> Column:
    """A number rounded for display."""
    return F.round(value, digits)
