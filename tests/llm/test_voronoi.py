import math

import numpy as np
import pytest

from logsieve.llm import voronoi


def brute(rows, k, is_query):
    whole = {}
    for key, v in rows:
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[key, tuple(math.floor(64 * float(x)) for x in v)] = None
    out = []
    for q, a in whole:
        if is_query(q):
            found = sorted((-sum(x * y for x, y in zip(a, b)), d) for d, b in whole if d != q)[:k]
            out += [(q, i + 1, d, -s) for i, (s, d) in enumerate(found)]
    return sorted(out)


def corpus(seed, clustered):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(700):
        v = centres[i % 6] + rng.normal(size=12) * (0.05 if clustered else 1.0)
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)]))
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    rows += [(2000, None), (2020, [1.0, None]), (2040, [float("nan")]), (2060, [float("inf"), 0.0]), (2080, []), (2100, [0.0] * 12), (2120, [3.0]), (2001, [0.5] * 15), (0, rows[0][1]), (None, [1.0])]
    return rows


@pytest.mark.parametrize("clustered,options", [(True, {}), (False, {}), (True, {"chunk": 7, "slice_": 50, "pivots": 9}), (False, {"k": 3, "chunk": 5, "slice_": 30})])
def test_top_k(spark, clustered, options):
    rows = corpus(3, clustered)
    vectors = spark.createDataFrame([(k, v, 7) for k, v in rows], "vec_id long, embedding array<float>, cid int").repartition(4)
    got = voronoi.top_k(vectors, **options).collect()
    assert sorted(map(tuple, got)) == brute(rows, options.get("k", 20), lambda q: q % 20 == 0)


@pytest.mark.parametrize("clustered", [True, False])
def test_ids_with_several_vectors(spark, clustered):
    rng = np.random.default_rng(4)
    rows = corpus(4, clustered)
    near = rows[20][1]
    rows += [(20, [float(np.float32(x + 0.02 * e)) for x, e in zip(near, rng.normal(size=12))]) for _ in range(30)]
    rows += [(3000, v) for _, v in rows[:300]] + [(40, near), (40, [9.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    for options in ({}, {"chunk": 9, "slice_": 40, "k": 4}):
        k = options.get("k", 20)
        got = sorted(map(tuple, voronoi.top_k(vectors, **options).collect()))
        assert got == brute(rows, k, lambda q: q % 20 == 0)
        assert sum(r[0] == 20 for r in got) == 31 * k


def test_pruning(spark):
    """In clusters, bounds leave out most of the data; without any, the groups share one copy of it for each chunk."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 16))
    parts = []
    for spread in (0.02, 1.0):
        rows = [(i, [float(x) for x in np.float32(centres[i % 20] + spread * rng.normal(size=16))]) for i in range(4000)]
        figures = {}
        got = voronoi.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), figures=figures)
        assert sorted(map(tuple, got.collect())) == brute(rows, 20, lambda q: q % 20 == 0)
        parts.append(figures["rows"] / figures["rows_without_bounds"])
        assert figures["rows"] <= 4000 * max(figures["groups"], 1)
    assert parts[0] < 0.6 and parts[1] <= 1


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert voronoi.top_k(spark.createDataFrame([], schema)).collect() == []
    assert voronoi.top_k(spark.createDataFrame([(20, [1.0])], schema)).collect() == []
    assert voronoi.top_k(spark.createDataFrame([(1, [1.0])], schema)).collect() == []
    got = voronoi.top_k(spark.createDataFrame([(20, [1.0]), (3, [-1.0]), (2, [1.0])], schema)).collect()
    assert sorted(map(tuple, got)) == [(20, 1, 2, 4096), (20, 2, 3, -4096)]


def test_large_numbers_stay_exact():
    a = np.array([[2**40, 1]], np.int64)
    assert voronoi._products(a, np.array([[2**20, 3]], np.int64)).tolist() == [[2**60 + 3]]
