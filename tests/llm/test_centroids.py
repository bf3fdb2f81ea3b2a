import hashlib
import math
import random

import numpy as np
import pytest

from logsieve.llm import centroids


@pytest.mark.parametrize("seed", range(6))
def test_walk_finds_the_nearest(seed):
    rng = np.random.default_rng(seed)
    k, width, top = [(1, 5, 9), (8, 64, 1000), (30, 3, 4), (7, 1, 3), (50, 8, 100), (12, 64, 1 << 27)][seed]
    vectors, points = rng.integers(-top, top + 1, (400, width)), rng.integers(-top, top + 1, (k, width))
    points[k // 2] = points[0]
    number, distance, tried = centroids.nearest(vectors, points)
    every = ((vectors[:, None, :] - points[None, :, :]) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert tried.max() <= k and (tried >= 1).all()


def test_walk_stops_early():
    rng = np.random.default_rng(9)
    points = rng.integers(-10_000, 10_000, (200, 4))
    vectors = points[rng.integers(0, 200, 1000)] + rng.integers(-20, 21, (1000, 4))
    _, _, tried = centroids.nearest(vectors, points)
    assert tried.mean() < 20


def brute(rows, k, rounds, width):
    kept = [(key, [math.floor(max(-(1 << 27), min(1 << 27, 1024 * x))) for x in v]) for key, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    points = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), i) for i, p in enumerate(points)) for _, v in kept]

    for _ in range(rounds):
        of = assign()
        for i in range(len(points)):
            own = [v for (_, v), (_, c) in zip(kept, of) if c == i]
            if own:
                points[i] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    inertia = [sum(d for d, c in found if c == i) for i in range(len(points))]
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    fits = lambda x: x if x < 1 << 63 else None
    return sorted((str(key), c, d, fits(inertia[c]), fits(sum(inertia)), sha[c]) for (key, _), (d, c) in zip(kept, found)), points


def run(spark, rows, **options):
    frame = spark.createDataFrame([(v, k, "x", 1) for k, v in rows], "embedding array<float>, vec_id long, v string, cluster int").repartition(3)
    assigned, found = centroids.cluster(frame, **options)
    got = centroids.with_inertia(assigned, found).drop("n_tried").collect() if len(found) else assigned.collect()
    return sorted((str(r[0]), *r[1:]) for r in got), found.tolist()


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    middle = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(5)]
    vec = lambda: [float(np.float32(x + rng.gauss(0, 0.2))) for x in rng.choice(middle)]
    rows = [(i, vec()) for i in range(150)] + [(7, vec()), (None, vec()), (None, vec())]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [rows[5], rows[5]]
    rows += [(300, None), (301, []), (302, [1.0] * 3), (303, [None, 1.0, 1.0, 1.0]), (304, [math.nan] * 4), (305, [math.inf, 0.0, 0.0, 0.0]), (306, [0.0] * 4)]
    monkeypatch.setattr(centroids, "BLOCK_NUMBERS", 64)
    for k in (8, 3):
        assert run(spark, rows, k=k, dimensions=4) == brute(rows, k, 10, 4)
    rows += [(400, [3e38, -3e38, 0.0, 1.0]), (401, [1e9, 1e9, 1e9, 1e9])]
    assert run(spark, rows, k=4, rounds=3, dimensions=4) == brute(rows, 4, 3, 4)


def test_few_and_no_rows(spark):
    rows = [(1, [1.0, 0.5]), (2, [-1.0, 0.25])]
    assert run(spark, rows, dimensions=2) == brute(rows, 8, 10, 2)
    assert run(spark, [], dimensions=2)[0] == [] and run(spark, [(1, None)], dimensions=2)[0] == []
    with pytest.raises(ValueError):
        centroids.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>"), dimensions=1024)
