"""Exact top-k search by inner product as a Voronoi k-nearest-neighbour join.

Vectors become integers, floor(scale * x). With one more coordinate, sqrt(M - |v|^2) for data (M: the largest squared
norm) and 0 for queries, the largest inner products are the nearest neighbours. Equal vectors are one class, which keeps
its k + 1 smallest ids: no query can need more of them.

1. Pivots drawn by a hash (the square root of the number of classes, halved; at most PIVOTS) cut the space. Data and
   queries join the group of their nearest pivot.
2. Summaries of the data groups (size, radius, the k + 1 smallest distances) bound, for each query by itself, how far its
   (k + 1)-th neighbour can be. From this follow the data groups that it can meet, and a reach around its group's centre
   that holds all it needs; a query group's reach is the largest of these.
3. A class goes only to the query groups whose reach it is in; whole data groups that no query of a group can meet are
   skipped. Query groups that still need over half of the data share one: their data is sent once for all of them.
4. A query group is cut into chunks of queries and slices of data; each pair of them is solved with a matrix product,
   and the slices' best are merged.

A query whose id has several vectors must not find any of them. It is solved by itself, with its own id left out, in the
shared group, for the summaries count rows that it may not use.

Scale: only pivots and summaries (PIVOTS * (PIVOTS + k) numbers) reach the driver. No task holds more than a chunk and a
slice, both bounded in numbers, and a product is made for at most BLOCK queries at once. What is replicated depends on
how the vectors cluster: where no bound holds, each chunk of queries meets all data, as any exact search must.

Edge cases: vectors that are null or hold null or non-finite components take no part; shorter vectors count as if
filled with zeros, an empty one scores 0; rows with equal id and vector are one row; a row never finds rows with its
own id; fewer than k others give fewer ranks; an empty table gives no rows; other columns are ignored. Scores are
exact while they fit into 64 bits; components beyond 64 bits are cut to the largest long.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logsieve.llm.common import same, stored

SCALE, K = 64, 20
PIVOTS, BLOCK = 128, 128
#: Vectors in a chunk of queries and a slice of data, and the numbers that they hold at most.
CHUNK, SLICE, CHUNK_NUMBERS, SLICE_NUMBERS = 2048, 16_384, 1 << 18, 1 << 20
_SLACK = 1e-6


def quantized(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    x = F.col("x")
    kept = vectors.select(vectors[key].alias("vec_id"), vectors[vector].alias("x")).where(
        x.isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    )
    return kept.select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def _matrix(lists: pa.ListArray, width: int = 0) -> np.ndarray:
    """Rows of integers, filled with zeros to the longest (and to `width`)."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths()).astype(np.int64)
    width = max(width, int(sizes.max(initial=0)))
    flat = np.asarray(lists.flatten()).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows; in floating point where that is exact."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (a, b))
    top = [float(np.abs(x).max(initial=0)) for x in (a, b)]
    if width * top[0] * top[1] < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _distances(vectors: np.ndarray, pivots: np.ndarray, extra: float) -> np.ndarray:
    """Euclidean distances, `extra` added under the root (one number, or one for each pivot or vector)."""
    width = max(vectors.shape[1], pivots.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))).astype(np.float64) for x in (vectors, pivots))
    square = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square + extra, 0))


def _assign(pivots: np.ndarray, most: float):
    """Adds the nearest pivot's number and its distance to data, with the added coordinate."""
    lift = np.sqrt(np.maximum(most - (pivots.astype(np.float64) ** 2).sum(1), 0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"))
            own = np.sqrt(np.maximum(most - (v.astype(np.float64) ** 2).sum(1), 0))[:, None] - lift[None, :]
            far = _distances(v, pivots, own**2)
            near = far.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(near)), near])],
                names=[*batch.schema.names, "pivot", "far"],
            )

    return run


def _bounded(pivots: np.ndarray, most: float, summary: dict[int, tuple[int, float, list[float]]], k: int):
    """Adds to queries their group, the reach around its centre and, as a bit for each data group, whether it can matter."""
    held = sorted(summary)
    lift = np.maximum(most - (pivots.astype(np.float64) ** 2).sum(1), 0)[held]
    sizes = [len(summary[j][2]) for j in held]
    least = np.concatenate([summary[j][2] for j in held]) if held else np.zeros(0)
    radius, of = np.array([summary[j][1] for j in held]), np.repeat(np.arange(len(held)), sizes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                v = _matrix(part.column("v"))
                plain = _distances(v, pivots, 0.0)
                group = plain.argmin(1)
                far = np.sqrt(plain[:, held] ** 2 + lift[None, :])
                bound = np.full(len(v), np.inf)
                if len(least) > k:
                    bound = np.partition(far[:, of] + least[None, :], k, axis=1)[:, k] * (1 + _SLACK) + _SLACK
                reach = (bound + plain[np.arange(len(v)), group]) * (1 + _SLACK) + _SLACK
                needs = np.zeros((len(v), len(pivots)), bool)
                needs[:, held] = far - radius[None, :] <= bound[:, None]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(group.astype(np.int32)), pa.array(reach), pa.array([x.tobytes() for x in np.packbits(needs, axis=1)], pa.binary())],
                    names=[*part.schema.names, "pivot", "reach", "needs"],
                )

    return run


def _groups_needed(pivots: int):
    """(pivot, other): the data groups that any query of a group needs, once for each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((pivots, pivots), bool)
        for batch in batches:
            bits = np.frombuffer(b"".join(batch.column("needs").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            np.logical_or.at(seen, batch.column("pivot").to_numpy(), np.unpackbits(bits, axis=1)[:, :pivots].astype(bool))
        i, j = np.nonzero(seen)
        yield pa.RecordBatch.from_pydict({"pivot": i.astype(np.int32), "other": j.astype(np.int32)})

    return run


class _Reach:
    """Which classes the query groups need: those in reach of the centre, in data groups that are open to the group."""

    def __init__(self, centres: np.ndarray, most: float, reach: np.ndarray, open_to: np.ndarray, shared: np.ndarray):
        self.centres, self.most, self.reach, self.open_to, self.shared = centres, most, reach, open_to, shared

    def needed(self, batch: pa.RecordBatch) -> np.ndarray:
        v, pivot = _matrix(batch.column("v")), batch.column("pivot").to_numpy()
        norms = (v.astype(np.float64) ** 2).sum(1)
        far = _distances(v, self.centres, np.maximum(self.most - norms, 0)[:, None])
        return (far <= self.reach[None, :]) & self.open_to[pivot]

    def count(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(self.centres), np.int64)
        for batch in batches:
            total += self.needed(batch).sum(0)
        yield pa.RecordBatch.from_pydict({"grp": np.arange(len(total), dtype=np.int32), "n": total})

    def replicate(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row (grp, ...) for each query group that needs the class; group -1 is the shared one and gets all."""
        for batch in batches:
            needed = self.needed(batch) & ~self.shared[None, :]
            rows, group = np.nonzero(needed)
            if self.shared.any():
                rows, group = np.r_[np.arange(len(needed)), rows], np.r_[np.full(len(needed), -1), group]
            for at in range(0, len(rows), 10_000):
                part = batch.select(["cid", "v", "ids"]).take(pa.array(rows[at : at + 10_000]))
                yield pa.RecordBatch.from_arrays([pa.array(group[at : at + 10_000].astype(np.int32)), *part.columns], names=["grp", "cid", "v", "ids"])


def _solve(k: int):
    """The k best (score, id) of a slice for each query of a chunk; ids equal to the query's `own` are left out."""

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        q, s = _matrix(queries.column("v")), _matrix(data.column("v"))
        ids = data.column("ids").combine_chunks()
        sizes = np.asarray(ids.value_lengths()).astype(np.int64)
        flat, start = np.asarray(ids.flatten()), np.concatenate([[0], np.cumsum(sizes)])
        out: list[tuple] = [(np.zeros(0, np.int64),) * 3]
        uids, owns = queries.column("uid").to_numpy(), queries.column("own").to_pylist()
        for at in range(0, len(q) if len(s) else 0, BLOCK):
            scores = _products(q[at : at + BLOCK], s)
            for i in range(len(scores)):
                score, own, barred = scores[i], owns[at + i], 0
                if own is not None:
                    alone = (sizes == 1) & (flat[start[:-1]] == own)
                    score, barred = np.where(alone, np.iinfo(np.int64).min, score), int(alone.sum())
                cut = max(len(s) - barred - k, 0) + barred
                if barred == len(s):
                    continue
                least = np.partition(score, cut)[cut]
                found = np.flatnonzero(score >= least)
                number = np.repeat(score[found], sizes[found])
                at_id = np.concatenate([flat[start[c] : start[c + 1]] for c in found])
                if own is not None:
                    number, at_id = number[at_id != own], at_id[at_id != own]
                best = np.lexsort((at_id, -number))[:k]
                out.append((np.full(len(best), uids[at + i]), at_id[best], number[best]))
        uid, vec, score = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"uid": uid.astype(np.int64), "vec_id": vec.astype(np.int64), "score": score.astype(np.int64)})

    return run


def _summaries(classes: DataFrame, k: int) -> dict[int, tuple[int, float, list[float]]]:
    """Of each data group: size, radius and the k + 1 smallest distances to its pivot."""
    nearest = F.row_number().over(W.partitionBy("pivot").orderBy("far"))
    least = classes.select("pivot", "far").withColumn("n", nearest).where(F.col("n") <= k + 1)
    least = least.groupBy("pivot").agg(F.sort_array(F.collect_list("far")).alias("least"))
    whole = classes.groupBy("pivot").agg(F.count(F.lit(1)).alias("size"), F.max("far").alias("radius"))
    return {r.pivot: (r.size, r.radius, list(r.least)) for r in whole.join(least, "pivot").select("pivot", F.col("size").alias("size"), "radius", "least").collect()}


def top_k(
    vectors: DataFrame,
    is_query: Column | None = None,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    pivots: int = PIVOTS,
    chunk: int = CHUNK,
    slice_: int = SLICE,
    figures: dict | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score); is_query is a condition on vec_id, by default that 20 divides it.

    `figures`, if given, gets the numbers of classes, of groups, of shared groups and of the rows that data is sent as.
    """
    is_query = F.col("vec_id") % 20 == 0 if is_query is None else is_query
    rows = stored(quantized(vectors, key, vector, scale).where(F.col("vec_id").isNotNull()), "vectors")
    place = F.dense_rank().over(W.partitionBy("v").orderBy("vec_id"))
    classes = rows.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("v")
    classes = classes.agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    asked = rows.where(is_query).join(classes.select("v", "cid"), "v").select(F.col("vec_id").alias("query_id"), "cid", "v")
    asked = stored(asked.dropDuplicates(["query_id", "cid"]), "asked")
    several = asked.groupBy("query_id").agg(F.min("cid").alias("a"), F.max("cid").alias("b")).where("a <> b").select("query_id", F.lit(True).alias("several"))
    asked = asked.join(several, "query_id", "left").withColumn("own", F.when(F.col("several"), F.col("query_id"))).drop("several")
    units = stored(asked.select("cid", "own", "v").dropDuplicates(["cid", "own"]).withColumn("uid", F.monotonically_increasing_id()), "units")

    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    most, width, n = classes.agg(F.max(square), F.max(F.size("v")), F.count(F.lit(1))).first()
    most, width = (most or 0.0) * (1 + 1e-9), max(width or 1, 1)
    chunk, slice_ = max(1, min(chunk, CHUNK_NUMBERS // width)), max(1, min(slice_, SLICE_NUMBERS // width))
    drawn = classes.orderBy(F.xxhash64("v"), "v").limit(max(1, min(pivots, int(n**0.5 / 2)))).select("v").collect()
    centres = _matrix(pa.array([r.v for r in drawn] or [[]], pa.list_(pa.int64())))

    grouped = stored(classes.mapInArrow(_assign(centres, most), "v array<long>, ids array<long>, cid long, pivot int, far double"), "grouped")
    summary = _summaries(grouped, k)
    bounded = units.mapInArrow(_bounded(centres, most, summary, k), "cid long, own long, v array<long>, uid long, pivot int, reach double, needs binary")
    bounded = stored(bounded, "queries")

    reach, open_to = np.full(len(centres), -1.0), np.zeros((len(centres), len(centres)), bool)
    single = bounded.where(F.col("own").isNull())
    for r in single.groupBy("pivot").agg(F.max("reach").alias("reach")).collect():
        reach[r.pivot] = r.reach
    for r in single.select("pivot", "needs").mapInArrow(_groups_needed(len(centres)), "pivot int, other int").distinct().collect():
        open_to[r.other, r.pivot] = True
    bounds = _Reach(centres, most, reach, open_to, np.zeros(len(centres), bool))
    needed = np.zeros(len(centres), np.int64)
    for r in grouped.mapInArrow(bounds.count, "grp int, n long").groupBy("grp").agg(F.sum("n").alias("n")).collect():
        needed[r.grp] = r.n
    bounds.shared = (2 * needed > n) | (len(centres) == 1)
    group = F.when(F.col("own").isNotNull() | F.array_contains(F.lit(np.flatnonzero(bounds.shared).tolist() or [-1]), F.col("pivot")), -1).otherwise(F.col("pivot"))
    bounded = bounded.select(group.alias("grp"), "uid", "own", "v")
    counts = {r.grp: r.n for r in bounded.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    if -1 in counts and not bounds.shared.any():  # only queries with several vectors share the whole data
        bounds.shared[reach < 0] = True
        bounds.shared[needed.argmax()] |= not bounds.shared.any()
    layout = {g: (-(-c // chunk), max(1, -(-int(n if g < 0 else needed[g]) // slice_))) for g, c in counts.items()}
    if figures is not None:
        figures |= {"classes": n, "groups": len(centres), "shared": int(bounds.shared.sum()),
                    "rows": sum(c * int(n if g < 0 else needed[g]) for g, (c, _) in layout.items()),
                    "rows_without_bounds": sum(c * n for g, (c, _) in layout.items())}
    layout_of = F.create_map(*[F.lit(x) for g, (c, s) in layout.items() for x in (g, F.array(F.lit(c), F.lit(s)))]) if layout else F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<array<int>>"))

    def part(of: str, at: int) -> Column:
        return F.pmod(F.xxhash64(of, F.lit(at)), layout_of[F.col("grp")][at]).cast("int")

    def every(at: int) -> Column:
        return F.explode(F.sequence(F.lit(0), layout_of[F.col("grp")][at] - 1))

    q = bounded.withColumn("chunk", part("uid", 0)).withColumn("slice", every(1))
    d = grouped.mapInArrow(bounds.replicate, "grp int, cid long, v array<long>, ids array<long>").where(layout_of[F.col("grp")].isNotNull())
    d = d.withColumn("slice", part("cid", 1)).withColumn("chunk", every(0))
    keys = ["grp", "chunk", "slice"]
    best = q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInArrow(_solve(k + 1), "uid long, vec_id long, score long")
    order = W.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    best = best.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best"))

    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    of = units.select(F.col("cid").alias("_cid"), F.col("own").alias("_own"), "uid")
    named = asked.select("query_id", "cid", "own").join(of, (F.col("cid") == F.col("_cid")) & same(F.col("own"), F.col("_own")))
    ranked = named.join(best, "uid").select("query_id", F.posexplode(others))
    return ranked.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("col.vec_id").alias("vec_id"), F.col("col.score").alias("score"))
