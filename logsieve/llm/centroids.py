"""Centroid clustering with the threshold algorithm: exact nearest centroids from per-dimension sorted lists.

Vectors become integers, floor(scale * x). Each dimension keeps its centroids sorted by their value there. A vector walks
every list outward from its own value, one centroid a step in each dimension; a centroid that is met for the first time
gets its exact squared distance. No centroid that was not met yet can be nearer than the sum of the squared frontier
distances, so a vector stops when that sum strictly exceeds the best exact distance: ties are still met, and go to the
smaller number. The walk runs for a block of vectors at once; vectors that have stopped leave the block.

A round assigns all vectors, sums them by cluster inside each task, adds the sums up in Spark and replaces every
non-empty centroid by the componentwise floor(sum / count). All arithmetic is on integers.

Scale: vectors are written once as integers and read by each round; a round shuffles one row for each task, cluster and
dimension. Only the centroids (k * dimensions numbers) and the clusters' inertia (k numbers) reach the driver and the
tasks. A lost executor costs its tasks of one round.

Edge cases: vectors of another length, null ones and those with null or non-finite components take no part. A component
beyond +-LARGEST after scaling counts as that limit, so that a squared distance fits into 64 bits; an inertia that
doesn't fit is null. Rows with equal ids are rows of their own, the first centroids among them in order of their
vectors; a null id is hashed as an empty one. Fewer than k vectors give as many centroids; equal centroids are allowed.
Without vectors there are no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.llm.common import stored

K, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Largest size of a scaled component: 64 squares of twice this are below 2^63.
LARGEST = 1 << 27
#: Numbers that a block may hold for its walk (vectors * the larger of dimensions and centroids).
BLOCK_NUMBERS = 1 << 18


def scaled(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as integers."""
    x = F.col("x")
    kept = vectors.select(vectors[key].alias("vec_id"), vectors[vector].alias("x")).where(
        (F.size(x) == dimensions) & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    )
    near = lambda c: F.greatest(F.least(c.cast("double") * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))
    return kept.select("vec_id", F.transform(x, lambda c: F.floor(near(c)).cast("int")).alias("v"))


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the nearest centroid's number, its squared distance, and how many exact distances it took."""
    n, (k, width) = len(vectors), centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0).T.copy()
    which = order.T.copy()
    # One place outside each end that is farther than any centroid.
    far = np.int64(1) << 40
    lists = np.concatenate([np.full((width, 1), -far), lists, np.full((width, 1), far)], axis=1)
    which = np.concatenate([np.zeros((width, 1), np.int64), which, np.zeros((width, 1), np.int64)], axis=1)
    right = np.empty((n, width), np.int64)
    for j in range(width):
        right[:, j] = np.searchsorted(lists[j], vectors[:, j], side="left")
    left = right - 1
    best, cluster = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
    met, tried = np.zeros((n, k), bool), np.zeros(n, np.int64)
    dims, live = np.arange(width), np.arange(n)
    for _ in range(k):
        x, lo, hi = vectors[live], left[live], right[live]
        below, above = x - lists[dims, lo], lists[dims, hi] - x
        down = below <= above
        found = which[dims, np.where(down, lo, hi)]
        left[live], right[live] = lo - down, hi + ~down
        new = np.zeros((len(live), k), bool)
        new[np.arange(len(live))[:, None], found] = True
        new &= ~met[live]
        met[live] |= new
        tried[live] += new.sum(1)
        for c in np.flatnonzero(new.any(0)):
            rows = np.flatnonzero(new[:, c])
            distance = ((x[rows] - centroids[c]) ** 2).sum(1)
            at = live[rows]
            closer = (distance < best[at]) | ((distance == best[at]) & (c < cluster[at]))
            best[at[closer]], cluster[at[closer]] = distance[closer], c
        frontier = (np.minimum(below, above) ** 2).sum(1)
        live = live[frontier <= best[live]]
        if not len(live):
            break
    return cluster, best, tried


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return np.asarray(lists.flatten()).astype(np.int64).reshape(len(lists), width)


def _blocks(batches: Iterable[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    k, width = centroids.shape
    size = max(1, BLOCK_NUMBERS // max(k, width))
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield part, _matrix(part.column("v"), width)


def _sums(centroids: np.ndarray):
    """(cluster, pos, total, n) of a task: sums of the vectors of each cluster by dimension."""
    k, width = centroids.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for _, x in _blocks(batches, centroids):
            cluster, _, _ = nearest(x, centroids)
            order = np.argsort(cluster, kind="stable")
            held, starts = np.unique(cluster[order], return_index=True)
            total[held] += np.add.reduceat(x[order], starts, axis=0)
            n += np.bincount(cluster, minlength=k)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({
            "cluster": np.repeat(held, width).astype(np.int32), "pos": np.tile(np.arange(width, dtype=np.int32), len(held)),
            "total": total[held].ravel(), "n": np.repeat(n[held], width)})

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, centroids):
            cluster, distance, tried = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(tried.astype(np.int32))],
                names=["vec_id", "cluster", "distance", "n_tried"],
            )

    return run


def first_centroids(rows: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes, in the order of the hashes."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    found = rows.select(F.sha2(text.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in found], np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; empty ones stay."""
    sums = rows.select("v").mapInArrow(_sums(centroids), "cluster int, pos int, total long, n long")
    sums = sums.groupBy("cluster", "pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in sums.collect():
        out[r.cluster, r.pos] = int(r.total) // r.n
    return out


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance, n_tried) of every vector that takes part, and the final centroids.

    n_tried: how many exact distances the vector needed in the last assignment.
    """
    if dimensions * (2 * LARGEST) ** 2 >= 1 << 63:
        raise ValueError(f"squared distances in {dimensions} dimensions don't fit into 64 bits")
    rows = stored(scaled(vectors, key, vector, dimensions, scale), "scaled")
    centroids = first_centroids(rows, k, seed)
    kind = rows.schema["vec_id"].dataType.simpleString()
    layout = f"vec_id {kind}, cluster int, distance long, n_tried int"
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], layout), centroids
    for _ in range(rounds):
        after = moved(rows, centroids)
        if (after == centroids).all():  # further rounds change nothing
            break
        centroids = after
    return stored(rows.mapInArrow(_assigned(centroids), layout), "assigned"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds cluster_inertia, inertia and centroid_sha256; the k rows joined are collected, and so small."""
    found = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}

    def held(total: int) -> int | None:
        return total if total < 1 << 63 else None

    whole = held(sum(map(int, found.values())))
    rows = [(c, held(int(t)), whole, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, t in found.items()]
    of = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_tried"
    )
