"""The vector index against exact search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsieve.operators.nearest import nearest, nearest_batch
from logsieve.operators.vectorindex import VectorIndex

SCHEMA = "vec_id long, embedding array<float>"


def score(a, b, metric):
    if metric == "euclidean":
        return -math.dist(a, b)
    dot = sum(x * y for x, y in zip(a, b))
    return dot if metric == "dot" else dot / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))


def usable(v, metric):
    return v and all(x is not None and math.isfinite(x) for x in v) and (metric != "cosine" or any(v))


def brute(rows, asked, k, metric):
    out = []
    for q, a in asked:
        if usable(a, metric):
            found = sorted((-round(score(a, b, metric), 9), d) for d, b in rows if usable(b, metric) and len(a) == len(b))[:k]
            out += [(q, i + 1, d, -s) for i, (s, d) in enumerate(found)]
    return sorted(out)


def shown(found, key="vec_id"):
    return sorted((r.query_id, r["rank"], r[key], round(r.score, 9) + 0.0) for r in found.collect())


def corpus(seed, spread=0.1, n=900, width=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    rows = [(i, [float(x) for x in np.float32(centres[i % 12] + spread * rng.normal(size=width))]) for i in range(n)]
    odd = [(2000, None), (2020, []), (2040, [None] * width), (2060, [math.nan] * width), (2080, [math.inf] + [0.0] * (width - 1)),
           (2100, [0.0] * width), (2120, [1.0, 2.0]), (2140, [2.0, 1.0]), (2141, [-1.0, 0.5]), (2160, [3.0])]
    return rows + odd + [(3000 + i, rows[5][1]) for i in range(40)]


def stored(spark, tmp_path, rows):
    spark.createDataFrame([(k, v, "x", 1) for k, v in rows], SCHEMA + ", list string, code int").write.parquet(f"{tmp_path}/rows")
    return spark.read.parquet(f"{tmp_path}/rows")


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_exact_search(spark, tmp_path, metric):
    rows = corpus(1)
    vectors = stored(spark, tmp_path, rows)
    index = VectorIndex.ensure(vectors, f"{tmp_path}/index", metric)
    asked = [(k, v) for k, v in rows if k % 20 == 0]
    queries = vectors.filter(F.col("vec_id") % 20 == 0)
    expected = brute(rows, asked, 7, metric)
    places = [r[:3] for r in expected]
    assert [r[:3] for r in shown(index.search_exact(queries, 7))] == places
    assert [r[:3] for r in shown(nearest_batch(vectors, queries, 7, metric, slice_numbers=500, block_numbers=90))] == places
    true = {r[:1] + r[2:3] for r in brute(rows, asked, 10, metric)}
    got = {r[:1] + r[2:3] for r in shown(index.search(queries, 10))}
    assert len(got & true) >= 0.9 * len(true) and len(got) == len(true)


def test_clusters_read_few_lists(spark, tmp_path):
    vectors = stored(spark, tmp_path, corpus(2, spread=0.02, n=3000, width=16))
    index = VectorIndex.ensure(vectors, f"{tmp_path}/index")
    assert index.share_of_lists < 0.5 and index.recall >= 0.9
    read = index.lists_read(vectors.filter(F.col("vec_id") % 20 == 0), 10).first()
    assert read.read_search == read.queries * index.probes and read.read_exact < 0.6 * read.queries * read.lists
    files = index.vectors.inputFiles()
    again = VectorIndex.ensure(vectors, f"{tmp_path}/index")
    assert again.vectors.inputFiles() == files and again.probes == index.probes
    one = nearest(vectors.filter("size(embedding) = 16 and vec_id < 2000"), [float(x) for x in range(1, 17)], 3)
    assert one.count() == 3


def test_random_vectors_reach_the_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    from logsieve.sources.tables import library_path

    index = VectorIndex.ensure(vectors, library_path(spark, "vectors-test"))
    asked = vectors.filter(F.col("vec_id") % 20 == 0)
    exact = {(r.query_id, r.vec_id) for r in nearest_batch(vectors, asked, 10).collect()}
    got = {(r.query_id, r.vec_id) for r in index.search(asked, 10).collect()}
    assert len(got) == len(exact) and len(got & exact) >= 0.9 * len(exact)


def test_few_and_no_vectors(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    index = VectorIndex.build(empty, f"{tmp_path}/none")
    some = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0])], SCHEMA)
    assert index.search(some, 3).collect() == [] and index.search_exact(some, 3).collect() == []
    few = VectorIndex.build(some, f"{tmp_path}/few", "euclidean")
    assert [r[:3] for r in shown(few.search_exact(some, 3))] == [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1), (3, 1, 3)]
    assert few.search(some.limit(0), 3).collect() == []
    with pytest.raises(ValueError):
        VectorIndex.build(some, f"{tmp_path}/bad", "taxi")
