"""Exact nearest neighbours of query vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsieve.functions.vectors import METRICS, similarity

# Numbers that a block of queries and a slice of vectors hold at most: what one task works on.
BLOCK_NUMBERS, SLICE_NUMBERS = 1 << 17, 1 << 21
# Queries that are scored in one matrix product.
_AT_ONCE = 64


def _vector(numbers: Sequence[float]) -> Column:
    """A constant vector, folded by the optimizer; one literal and not one per number."""
    return F.split(F.lit(",".join(repr(float(x)) for x in numbers)), ",").cast("array<double>")


def _score(column: str, query: Sequence[float], metric: str) -> Column:
    length = math.sqrt(sum(float(x) * float(x) for x in query))
    return similarity(F.col(column), _vector(query), metric, F.lit(length))


def _check(metric: str, k: int) -> None:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    if k < 1:
        raise ValueError("k must be at least 1")


def nearest(vectors: DataFrame, query: Sequence[float], k: int, metric: str = "cosine",
            key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The ``k`` vectors most similar to one query vector, ties by key.

    Each task keeps its own k best, so only k rows per task are moved. Vectors of another
    size, and those that cannot be scored, are no hits. For ``euclidean`` the score is the
    negated distance.
    """
    _check(metric, k)
    sized = vectors.filter(F.size(column) == len(query))
    scored = sized.select(key, _score(column, query, metric).alias("score"))
    return scored.filter(F.col("score").isNotNull()).orderBy(F.desc("score"), F.asc(key)).limit(k)


def matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Rows of one length; a missing number becomes NaN."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)).reshape(len(lists), -1)


def scores(queries: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    """Scores of all vectors for all queries, larger is nearer; NaN where there is none."""
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        if metric == "euclidean":
            return -np.sqrt(np.stack([((vectors - q) ** 2).sum(1) for q in queries]))
        products = queries @ vectors.T
        if metric == "dot":
            return products
        return products / (np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :])


def best(score: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties by key; only finite numbers are scores."""
    scored = np.flatnonzero(np.isfinite(score))
    if len(scored) > k:
        least = np.partition(score[scored], len(scored) - k)[len(scored) - k]
        scored = scored[score[scored] >= least]
    return scored[np.lexsort((keys[scored], -score[scored]))][:k]


def best_of_slice(metric: str, k: int, key: str, layout: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The k best vectors of a slice for each query of a block."""

    def solve(asked: pa.Table, found: pa.Table) -> pa.Table:
        if not len(asked) or not len(found):
            return layout.empty_table()
        queries, vectors = matrix(asked.column("query")), matrix(found.column("vector"))
        keys = found.column(key).to_numpy()
        parts = []
        for at in range(0, len(queries), _AT_ONCE):
            for i, score in enumerate(scores(queries[at:at + _AT_ONCE], vectors, metric), at):
                places = best(score, keys, k)
                parts.append((np.full(len(places), i), places, score[places]))
        query, place, score = (np.concatenate(p) for p in zip(*parts))
        return pa.table([asked.column("query_id").take(pa.array(query)), found.column(key).take(pa.array(place)), score],
                        schema=layout)

    return solve


def arrow_layout(*columns: tuple[str, str]) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in columns])


def ranked(scored: DataFrame, k: int, key: str) -> DataFrame:
    """The k best rows ``(query_id, key, score)`` of each query, with their rank."""
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(key))
    rows = scored.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return rows.select("query_id", key, "score", F.col("rank").cast("long").alias("rank"))


def nearest_batch(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "cosine", key: str = "vec_id",
                  column: str = "embedding", block_numbers: int = BLOCK_NUMBERS,
                  slice_numbers: int = SLICE_NUMBERS) -> DataFrame:
    """Rows ``(query_id, key, score, rank)``: the ``k`` best vectors for each row of ``queries``.

    Queries, with the same columns as the vectors, are a table of any size. Both are cut by how
    many numbers they hold, queries into blocks and vectors into slices, so that what a task
    holds is bounded and the number of tasks grows with the tables. A block meets a slice in a
    matrix product and answers with the ``k`` best for each query: pairs never become rows. A
    query meets only vectors of its own size; vectors that cannot be scored, also for an infinite number, are no hits.
    """
    _check(metric, k)
    kind = vectors.schema[key].dataType.simpleString()
    found = vectors.select(key, F.col(column).alias("vector"), F.size(column).alias("size")).filter("size > 0")
    asked = queries.select(F.col(key).cast("long").alias("query_id"), F.col(column).alias("query"),
                           F.size(column).alias("size")).filter("size > 0")
    blocks, slices = (max(1, math.ceil((rows.agg(F.sum("size")).first()[0] or 0) / most))
                      for rows, most in ((asked, block_numbers), (found, slice_numbers)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    found = found.withColumn("slice", F.pmod(F.xxhash64(key, "vector"), F.lit(slices)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    place = ("size", "block", "slice")
    solve = best_of_slice(metric, k, key, arrow_layout(("query_id", "bigint"), (key, kind), ("score", "double")))
    scored = asked.groupBy(*place).cogroup(found.groupBy(*place)).applyInArrow(
        solve, f"query_id long, {key} {kind}, score double")
    return ranked(scored, k, key)
