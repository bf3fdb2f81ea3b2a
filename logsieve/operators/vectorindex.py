"""An index for nearest neighbours: inverted lists, residual product-quantisation codes, exact re-ranking.

Vectors are put into a space where near means a small Euclidean distance: cosine on unit vectors, the inner product with
one more coordinate that brings all vectors to the length of the longest. Coarse centroids cut the space into lists; a
vector is stored in the list of its nearest centroid, together with a code of a few bytes for what is left of it.

A search reads the codes of a query's nearest lists, keeps the best by their approximate distance and scores those
exactly. How many lists and how many candidates that takes is measured when the index is built, on some of its own
vectors against exact search, and stored with it. ``search_exact`` reads every list that can hold a better vector than
those found, which the distance to its centroid and its radius tell: its result is that of ``nearest_batch``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.functions.vectors import METRICS
from logsieve.operators.nearest import arrow_layout, best, best_of_slice, matrix, nearest_batch, ranked
from logsieve.sources.tables import source_state
from logsieve.sources.versions import Versions

# Vectors that centroids and codes are learned from, and the lists there are at most. What the driver holds: both times
# the numbers of a vector.
SAMPLE, MOST_LISTS = 16_384, 4096
# Numbers of a vector that one byte of its code stands for, and the values such a byte has.
NUMBERS_PER_BYTE, WORDS = 4, 256
# Codes in a slice of lists, numbers in a slice of vectors, queries of a slice that are looked up together, and at once.
CODE_SLICE, SLICE_NUMBERS, BLOCK, AT_ONCE = 65_536, 1 << 21, 1024, 64
# Queries that recall is measured with, the recall to reach, and neighbours it is measured at.
TRIALS, TARGET, TRIAL_K = 64, 0.95, 10
_ROUNDS, _SLACK = 12, 1e-9
# Candidates, for each neighbour wanted, of the search that only bounds an exact one.
BOUND_CANDIDATES = 4


def in_space(vectors: np.ndarray, metric: str, longest: float, queries: bool = False) -> np.ndarray:
    """Vectors where a smaller distance is a better score."""
    if metric == "cosine":
        vectors = vectors / np.abs(vectors).max(1, keepdims=True)
        return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    if metric == "dot":
        more = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0))
        return np.concatenate([vectors, more[:, None]], axis=1)
    return vectors


def squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of all rows."""
    found = (left**2).sum(1)[:, None] + (right**2).sum(1)[None, :] - 2 * left @ right.T
    return np.maximum(found, 0)


def learned(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means centroids; a centroid that loses all its points is put on one of the points."""
    draw = np.random.default_rng(seed)
    centres = points[draw.permutation(len(points))[:k]].copy()
    for _ in range(_ROUNDS):
        near = np.concatenate([squares(points[at:at + 4096], centres).argmin(1) for at in range(0, len(points), 4096)])
        n = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], points[draw.integers(len(points), size=len(centres))])
    return centres


@dataclass(frozen=True)
class Quantiser:
    """Centroids of the lists, and the words of each part of a code."""

    metric: str
    longest: float
    centres: np.ndarray  # lists x numbers
    words: np.ndarray    # parts x words x numbers of a part

    @staticmethod
    def learn(sample: np.ndarray, lists: int, metric: str, longest: float) -> "Quantiser":
        points = in_space(sample, metric, longest)
        centres = learned(points, max(1, min(lists, len(points))), 0)
        left = points - centres[squares(points, centres).argmin(1)]
        parts = -(-left.shape[1] // NUMBERS_PER_BYTE)
        left = np.pad(left, ((0, 0), (0, parts * NUMBERS_PER_BYTE - left.shape[1]))).reshape(len(left), parts, NUMBERS_PER_BYTE)
        n = max(1, min(WORDS, len(points) // 4))
        return Quantiser(metric, longest, centres, np.stack([learned(left[:, p], n, p + 1) for p in range(parts)]))

    def parts(self, rest: np.ndarray) -> np.ndarray:
        parts = len(self.words)
        return np.pad(rest, ((0, 0), (0, parts * NUMBERS_PER_BYTE - rest.shape[1]))).reshape(len(rest), parts, NUMBERS_PER_BYTE)

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, distance to its centroid, and code of each vector."""
        points = in_space(vectors, self.metric, self.longest)
        near = squares(points, self.centres).argmin(1)
        rest = points - self.centres[near]
        cut = self.parts(rest)
        codes = np.stack([squares(cut[:, p], words).argmin(1) for p, words in enumerate(self.words)], axis=1)
        return near, np.linalg.norm(rest, axis=1), codes.astype(np.uint8)

    def decoded(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What codes of these lists stand for, in the space."""
        rest = np.concatenate([words[codes[:, p]] for p, words in enumerate(self.words)], axis=1)
        return self.centres[lists] + rest[:, :self.centres.shape[1]]

    def near_lists(self, queries: np.ndarray, probes: int) -> np.ndarray:
        far = squares(in_space(queries, self.metric, self.longest, queries=True), self.centres)
        return np.argsort(far, axis=1, kind="stable")[:, :probes]


def in_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a bounded number of queries."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def by_shard(queries: pa.RecordBatch, query: np.ndarray, lists: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """A row for each query and each shard that holds one of its lists, with these lists."""
    held = shard[lists] >= 0
    query, lists = query[held], lists[held]
    order = np.lexsort((lists, shard[lists], query))
    query, lists = query[order], lists[order]
    own = shard[lists]
    first = np.flatnonzero(np.concatenate([[True], (query[1:] != query[:-1]) | (own[1:] != own[:-1])])) if len(query) else np.zeros(0, np.int64)
    of = pa.ListArray.from_arrays(pa.array(np.append(first, len(lists)), pa.int32()), pa.array(lists, pa.int32()))
    return pa.RecordBatch.from_arrays([*queries.take(pa.array(query[first])).columns, pa.array(own[first], pa.int32()), of],
                                      names=[*queries.schema.names, "shard", "lists"])


def needed(lists: pa.ChunkedArray, number: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A few queries at a time, those with the same first list together: their places, which lists each needs, and the
    places of the rows, by the number of their list, that any of them needs."""
    lists = lists.combine_chunks()
    sizes, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    order = np.lexsort((sizes, flat[starts]))
    for at in range(0, len(order), AT_ONCE):
        these = order[at:at + AT_ONCE]
        need = np.zeros((len(these), most), bool)
        for i, q in enumerate(these):
            need[i, flat[starts[q]:starts[q] + sizes[q]]] = True
        yield these, need, np.flatnonzero(need.any(0)[number])


def scores_of_pairs(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """The score of each row with the row beside it; NaN where there is none."""
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        if metric == "euclidean":
            return -np.sqrt(((left - right) ** 2).sum(1))
        products = (left * right).sum(1)
        return products if metric == "dot" else products / (np.linalg.norm(left, axis=1) * np.linalg.norm(right, axis=1))


def usable(vector: Column, metric: str) -> Column:
    """Whether a vector can be scored: no missing or infinite number, and not zero for cosine."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return fine & F.exists(vector, lambda x: x != 0) if metric == "cosine" else fine


@dataclass(frozen=True)
class VectorIndex:
    """``codes`` (list, key, code) and ``vectors`` (list, key, vector) in ranges of (list, key); ``others``: vectors of another size."""

    codes: DataFrame
    vectors: DataFrame
    others: DataFrame
    sizes: DataFrame  # list, n, radius
    quantiser: Quantiser
    key: str
    column: str
    probes: int
    candidates: int
    recall: float

    @property
    def width(self) -> int:
        return self.quantiser.centres.shape[1] - (self.quantiser.metric == "dot")

    @property
    def share_of_lists(self) -> float:
        """Part of the lists that a search reads for each query."""
        return min(1.0, self.probes / len(self.quantiser.centres))

    @staticmethod
    def ensure(vectors: DataFrame, path: str, metric: str = "cosine", key: str = "vec_id", column: str = "embedding",
               lists: int | None = None, target: float = TARGET) -> "VectorIndex":
        """The newest version of the stored index if it was made from these vectors as they are, else a new one."""
        spark, state = vectors.sparkSession, f"{metric}, {key}, {column}, {lists}, {target}: {source_state(vectors)}"
        folder = Versions(spark, path).ensure(
            state, lambda folder: VectorIndex.build(vectors, folder, metric, key, column, lists, target))
        return VectorIndex.load(spark, folder)

    @staticmethod
    def build(vectors: DataFrame, path: str, metric: str = "cosine", key: str = "vec_id", column: str = "embedding",
              lists: int | None = None, target: float = TARGET) -> "VectorIndex":
        """Learn, encode and store the vectors of the most frequent size, then measure how much a search must read."""
        if metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
        spark = vectors.sparkSession
        rows = vectors.select(key, F.col(column).alias("vector")).filter(usable(F.col("vector"), metric) & (F.size("vector") > 0))
        found = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(
            F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("longest")).orderBy(F.desc("n"), "size").first()
        width, n, longest = (found["size"], found["n"], math.sqrt(found["longest"])) if found else (1, 0, 1.0)
        own = rows.filter(F.size("vector") == width)
        sample = own.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE)
        # Written first: tasks then send their part of the sample to one task and not to the driver.
        sample.write.mode("overwrite").parquet(f"{path}/sample")
        points = np.array([r.vector for r in spark.read.parquet(f"{path}/sample").orderBy(F.xxhash64("vector"), "vector").collect()], np.float64).reshape(-1, width)
        if not len(points):
            points = np.ones((1, width))
        quantiser = Quantiser.learn(points, lists or min(MOST_LISTS, int(math.sqrt(n)) or 1), metric, longest)

        kind = vectors.schema[key].dataType.simpleString()
        element = rows.schema["vector"].dataType.simpleString()

        def encoded(batches):
            for batch in batches:
                near, far, codes = quantiser.encode(matrix(batch.column("vector")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.astype(np.int32)), batch.column(key), pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array(far), batch.column("vector")], names=["list", key, "code", "far", "vector"])

        files = max(1, n * width // SLICE_NUMBERS)
        own.mapInArrow(encoded, f"list int, {key} {kind}, code binary, far double, vector {element}").write.mode(
            "overwrite").parquet(f"{path}/unsorted")
        unsorted = spark.read.parquet(f"{path}/unsorted")
        unsorted.repartitionByRange(files, "list", key).sortWithinPartitions("list", key).write.mode("overwrite").parquet(f"{path}/lists")
        spark.createDataFrame([], unsorted.schema).write.mode("overwrite").parquet(f"{path}/unsorted")
        rows.filter(F.size("vector") != width).write.mode("overwrite").parquet(f"{path}/others")
        stored = spark.read.parquet(f"{path}/lists")
        stored.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/sizes")
        numbers = [("centres", i, row.tolist()) for i, row in enumerate(quantiser.centres)]
        numbers += [("words", i, row.ravel().tolist()) for i, row in enumerate(quantiser.words)]
        spark.createDataFrame(numbers, "kind string, place int, numbers array<double>").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/quantiser")
        VectorIndex._settle(spark, path, metric, longest, key, column, 1, 1, 0.0)
        index = VectorIndex.load(spark, path)
        VectorIndex._settle(spark, path, metric, longest, key, column, *index._measured(target))
        return VectorIndex.load(spark, path)

    @staticmethod
    def _settle(spark: SparkSession, path: str, *values) -> None:
        layout = "metric string, longest double, key string, vector string, probes int, candidates int, recall double"
        spark.createDataFrame([values], layout).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "VectorIndex":
        chosen = spark.read.parquet(f"{path}/settings").first()
        rows = spark.read.parquet(f"{path}/quantiser").orderBy("kind", "place").collect()
        centres = np.array([r.numbers for r in rows if r.kind == "centres"])
        words = np.array([r.numbers for r in rows if r.kind == "words"])
        quantiser = Quantiser(chosen.metric, chosen.longest, centres, words.reshape(len(words), -1, NUMBERS_PER_BYTE))
        lists = spark.read.parquet(f"{path}/lists")
        return VectorIndex(lists.select("list", chosen.key, "code"), lists.select("list", chosen.key, "vector"),
                           spark.read.parquet(f"{path}/others"), spark.read.parquet(f"{path}/sizes"), quantiser,
                           chosen.key, chosen.vector, chosen.probes, chosen.candidates, chosen.recall)

    def _measured(self, target: float) -> tuple[int, int, float]:
        """Probes, candidates and the recall they reach, on some of the index's own vectors against exact search."""
        trial = self.vectors.select(self.key, F.col("vector").alias(self.column)).orderBy(F.xxhash64("vector"), self.key).limit(TRIALS)
        exact = nearest_batch(self.vectors, trial, TRIAL_K, self.quantiser.metric, self.key, "vector") if self.column == "vector" else (
            nearest_batch(self.vectors.withColumnRenamed("vector", self.column), trial, TRIAL_K, self.quantiser.metric, self.key, self.column))
        true = exact.join(self.codes.select("list", self.key), self.key).select("query_id", self.key, "list").collect()
        if not true:
            return 1, TRIAL_K, 1.0
        asked = {r[self.key]: np.array(r[self.column], np.float64) for r in trial.collect()}
        order = {q: {l: i for i, l in enumerate(self.quantiser.near_lists(v[None, :], len(self.quantiser.centres))[0].tolist())}
                 for q, v in asked.items()}
        place = np.sort([order[r.query_id][r.list] for r in true])
        # Half of what may be lost, by the lists; the rest is for the codes.
        probes = int(place[min(len(place) - 1, math.ceil(len(place) * (1 + target) / 2) - 1)]) + 1
        wanted = {(r.query_id, r[self.key]) for r in true}
        candidates, seen = 4 * TRIAL_K, -1
        while True:
            got = self.search(trial, TRIAL_K, probes, candidates).select("query_id", self.key).collect()
            hits = len(wanted & {tuple(r) for r in got})
            if hits >= target * len(wanted) or hits == seen and candidates >= 64 * TRIAL_K:
                return probes, candidates, hits / len(wanted)
            candidates, seen = 2 * candidates, hits

    def _asked(self, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Queries of the index's size, as (query_id, query), and those of other sizes."""
        rows = queries.select(F.col(self.key).cast("long").alias("query_id"), F.col(self.column).alias("query"))
        rows = rows.filter(usable(F.col("query"), self.quantiser.metric) & (F.size("query") > 0))
        return rows.filter(F.size("query") == self.width), rows.filter(F.size("query") != self.width)

    def _elsewhere(self, queries: DataFrame, k: int) -> DataFrame:
        """Exact search among vectors of other sizes, which have no lists."""
        return nearest_batch(self.others.withColumnRenamed("vector", self.column),
                             queries.select(F.col("query_id").alias(self.key), F.col("query").alias(self.column)),
                             k, self.quantiser.metric, self.key, self.column).drop("rank")

    def _shards(self, most: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """The shard of each list, -1 of one without vectors, and (list, shard, slices).

        Lists side by side share a shard as long as they hold no more than ``most`` vectors together;
        a list that holds more is a shard of its own, in slices.
        """
        shard, cuts, number, held = np.full(len(self.quantiser.centres), -1), [], -1, most
        for list_, n in sorted((r.list, r.n) for r in self.sizes.collect()):  # no more rows than there are lists
            if held + n > most:
                number, held = number + 1, 0
            held += n
            shard[list_] = number
            cuts.append((list_, number, math.ceil(n / most)))
        return shard, cuts

    def _dealt(self, pairs: DataFrame, rows: DataFrame, cuts: list[tuple[int, int, int]]) -> tuple[DataFrame, DataFrame, tuple[str, ...]]:
        """Queries of a shard in blocks, its rows in slices; every block meets every slice of its shard.

        What is sent grows with the shards that a query needs, not with its lists.
        """
        spark = rows.sparkSession
        asked = pairs.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        lists = spark.createDataFrame(cuts, "list int, shard int, slices int").coalesce(1)
        shards = lists.groupBy("shard").agg(F.max("slices").alias("slices")).join(asked, "shard")
        # No more rows than there are lists, MOST_LISTS.
        shards, lists = F.broadcast(shards), F.broadcast(lists.select("list", "shard").join(shards, "shard"))
        every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
        left = pairs.join(shards, "shard").withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks").cast("int")).withColumn("slice", every("slices"))
        right = rows.join(lists, "list").withColumn("slice", F.pmod(F.xxhash64(self.key), "slices").cast("int")).withColumn("block", every("blocks"))
        return left.drop("blocks", "slices"), right.drop("blocks", "slices"), ("shard", "block", "slice")

    def search(self, queries: DataFrame, k: int, probes: int | None = None, candidates: int | None = None) -> DataFrame:
        """Rows ``(query_id, key, score, rank)``: nearly the k best vectors for each query, their scores exact."""
        probes = probes or self.probes
        most = max(k, candidates or math.ceil(self.candidates * max(1.0, k / TRIAL_K)))
        quantiser, key = self.quantiser, self.key
        kind = self.codes.schema[key].dataType.simpleString()
        asked, elsewhere = self._asked(queries)

        shard, cuts = self._shards(CODE_SLICE)

        def near(batches):
            for batch in in_blocks(batches):
                lists = quantiser.near_lists(matrix(batch.column("query")), probes)
                yield by_shard(batch, np.repeat(np.arange(batch.num_rows), lists.shape[1]), lists.ravel(), shard)

        element = asked.schema["query"].dataType.simpleString()
        pairs = asked.mapInArrow(near, f"query_id long, query {element}, shard int, lists array<int>")
        layout = arrow_layout(("query_id", "bigint"), ("list", "int"), (key, kind), ("far", "double"))

        def look(of: pa.Table, codes: pa.Table) -> pa.Table:
            if not len(of) or not len(codes):
                return layout.empty_table()
            points = in_space(matrix(of.column("query")), quantiser.metric, quantiser.longest, queries=True)
            number, keys = codes.column("list").to_numpy(), codes.column(key).to_numpy()
            code = np.frombuffer(b"".join(codes.column("code").to_pylist()), np.uint8).reshape(len(codes), -1)
            stands, parts = quantiser.decoded(number, code), []
            for at, need, held in needed(of.column("lists"), number, len(quantiser.centres)):
                far = squares(points[at], stands[held])
                for i, own, row in zip(at, need, far):
                    places = best(np.where(own[number[held]], -row, -np.inf), keys[held], most)
                    parts.append((np.full(len(places), i), held[places], row[places]))
            query, place, far = (np.concatenate(p) for p in zip(*parts))
            return pa.table([of.column("query_id").take(pa.array(query)), pa.array(number[place].astype(np.int32)),
                             codes.column(key).take(pa.array(place)), far], schema=layout)

        left, right, place = self._dealt(pairs, self.codes, cuts)
        found = left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(look, f"query_id long, list int, {key} {kind}, far double")
        kept = ranked(found.select("query_id", "list", F.col(key).alias("_key"), (-F.col("far")).alias("score")).withColumnRenamed("_key", key)
                      .select("query_id", F.struct("list", key).alias("at"), "score"), most, "at")
        kept = kept.select("query_id", "at.list", F.col(f"at.{key}").alias(key)).join(asked, "query_id")
        vectors = self.vectors.join(kept, ["list", key]).select("query_id", "query", key, "vector")
        exact = arrow_layout(("query_id", "bigint"), (key, kind), ("score", "double"))

        def scored(batches):
            for batch in batches:
                score = scores_of_pairs(matrix(batch.column("query")), matrix(batch.column("vector")), quantiser.metric)
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column(key), pa.array(score)], schema=exact)

        rows = vectors.mapInArrow(scored, f"query_id long, {key} {kind}, score double")
        return ranked(rows.unionByName(self._elsewhere(elsewhere, k)), k, key)

    def _reachable(self, queries: DataFrame, k: int, shard: np.ndarray) -> DataFrame:
        """(query_id, query, shard, lists): the lists that can hold a vector as near as the k-th that a search finds.

        Any k vectors bound what is out of reach, so a few candidates are enough for that search.
        """
        quantiser = self.quantiser
        asked, _ = self._asked(queries)
        worst = self.search(queries, k, candidates=BOUND_CANDIDATES * k).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
        rows = asked.join(worst, "query_id", "left").select("query_id", "query", F.when(F.col("n") >= k, F.col("worst")).alias("worst"))
        radius = np.full(len(quantiser.centres), -1.0)
        for r in self.sizes.collect():  # no more rows than there are lists
            radius[r.list] = r.radius

        def reachable(batches):
            for batch in in_blocks(batches):
                vectors = matrix(batch.column("query"))
                points = in_space(vectors, quantiser.metric, quantiser.longest, queries=True)
                worst = batch.column("worst").to_numpy(zero_copy_only=False)
                if quantiser.metric == "euclidean":
                    bound = -worst
                elif quantiser.metric == "cosine":
                    bound = np.sqrt(np.maximum(2 - 2 * worst, 0))
                else:
                    bound = np.sqrt(np.maximum((points**2).sum(1) + quantiser.longest**2 - 2 * worst, 0))
                bound = np.where(np.isnan(bound), np.inf, bound) * (1 + 1e-6) + 1e-6
                far = np.sqrt(squares(points, quantiser.centres))
                query, lists = np.nonzero((far - radius[None, :] * (1 + _SLACK) <= bound[:, None]) & (radius[None, :] >= 0))
                yield by_shard(batch.select(["query_id", "query"]), query, lists, shard)

        return rows.mapInArrow(reachable, f"query_id long, query {asked.schema['query'].dataType.simpleString()}, shard int, lists array<int>")

    def search_exact(self, queries: DataFrame, k: int) -> DataFrame:
        """Rows ``(query_id, key, score, rank)`` as ``nearest_batch`` gives them, from the lists that can matter."""
        kind = self.codes.schema[self.key].dataType.simpleString()
        shard, cuts = self._shards(max(1, SLICE_NUMBERS // self.width))
        left, right, place = self._dealt(self._reachable(queries, k, shard), self.vectors, cuts)
        layout = arrow_layout(("query_id", "bigint"), (self.key, kind), ("score", "double"))
        best_of, lists = best_of_slice(self.quantiser.metric, k, self.key, layout), len(self.quantiser.centres)

        def solve(of: pa.Table, found: pa.Table) -> pa.Table:
            """Queries that need the same lists meet them together; a list more than needed changes no result."""
            if not len(of) or not len(found):
                return layout.empty_table()
            parts = [best_of(of.take(pa.array(at)), found.take(pa.array(held)))
                     for at, _, held in needed(of.column("lists"), found.column("list").to_numpy(), lists)]
            return pa.concat_tables(parts)

        rows = left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(solve, f"query_id long, {self.key} {kind}, score double")
        return ranked(rows.unionByName(self._elsewhere(self._asked(queries)[1], k)), k, self.key)

    def lists_read(self, queries: DataFrame, k: int) -> DataFrame:
        """``queries, lists, read_search, read_exact``: the lists that both searches read, added up over the queries."""
        exact = self._reachable(queries, k, self._shards(CODE_SLICE)[0]).agg(F.coalesce(F.sum(F.size("lists")), F.lit(0)).alias("read_exact"))
        asked = self._asked(queries)[0].agg(F.count(F.lit(1)).alias("queries"))
        n = len(self.quantiser.centres)
        return asked.select("queries", F.lit(n).cast("long").alias("lists"), (F.col("queries") * min(n, self.probes)).alias("read_search"),
                            exact.select("read_exact").scalar().alias("read_exact"))
