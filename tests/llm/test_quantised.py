import math

import numpy as np
import pytest

from logsieve.llm import quantised


def brute(rows):
    """{row: (n_links, component_id, kept)} and the links, from all pairs."""
    n = len(rows)
    fit = [v is not None and len(v) > 0 and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    unit = [np.array(v) / np.linalg.norm(v) if f else None for (_, v, _), f in zip(rows, fit)]
    links = [(i, j) for i in range(n) if fit[i] for j in range(n) if i != j and fit[j] and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98]
    of = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in links:
            if of[j] < of[i]:
                of[i], changed = of[j], True
    out = []
    for i, (key, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if of[j] == of[i] and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((str(key), sum(a == i for a, _ in links), component, key is not None and key == component))
    return sorted(out, key=str), links


def run(spark, rows, **options):
    frame = spark.createDataFrame([(label, 1, v, key, "x") for key, v, label in rows], "label int, n int, embedding array<float>, vec_id long, cid string")
    got = quantised.near_duplicates(frame.repartition(3), **options).collect()
    return sorted(((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in got), key=str)


def corpus(seed, n=120, width=12, near=0.03):
    rng = np.random.default_rng(seed)
    as_list = lambda v: [float(x) for x in v.astype(np.float32)]
    middles = rng.standard_normal((8, width))
    rows = []
    for i in range(n):
        m = middles[int(rng.integers(8))]
        v = m + near * np.linalg.norm(m) / math.sqrt(width) * rng.standard_normal(width) * rng.choice([1, 4]) if i % 2 else rng.standard_normal(width)
        rows.append((int(i), as_list(v * rng.choice([1, 3])), int(rng.integers(3)) if i % 9 else None))
    rows += [(500 + i, rows[1][1], 0) for i in range(40)] + [(600 + i, rows[1][1], 1) for i in range(5)]
    rows += [(7, rows[3][1], 1), (None, rows[1][1], 0), (None, rows[5][1], 2), (None, None, None), (None, as_list(rng.standard_normal(width)), 2)]
    rows += [(700, None, 1), (701, [], 1), (702, [0.0] * width, 1), (703, [0.0] * width, 1), (704, [None] + [1.0] * (width - 1), 1),
             (705, [math.nan] * width, 1), (706, [math.inf] * width, 1), (707, [1.0, 2.0], 1), (708, [2.0, 4.0], 1), (709, [-1.0, -2.0], 1), (710, [3.0], 1), (711, [5.0], 1)]
    return rows + [rows[1], rows[1]]


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 7)])
def test_against_brute_force(spark, monkeypatch, seed, block):
    """Parts of two bits: every pair shares one, so that no link can be missed."""
    monkeypatch.setattr(quantised, "BLOCK", block)
    monkeypatch.setattr(quantised, "TASK_ROWS", 50)
    rows = corpus(seed)
    expected, links = brute(rows)
    assert len(links) > 1000 and run(spark, rows, part=2) == expected


def test_recall_and_precision(spark):
    """Near copies all the way down to the limit, in 64 dimensions with the production parameters."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        v = rng.standard_normal(64)
        v /= np.linalg.norm(v)
        w = rng.standard_normal(64)
        w -= (w @ v) * v
        angle = math.acos(rng.uniform(0.97, 0.995))
        rows += [(2 * i, v.tolist(), i % 4), (2 * i + 1, (math.cos(angle) * v + math.sin(angle) * w / np.linalg.norm(w)).tolist(), i % 4)]
    rows = [(k, [float(x) for x in np.float32(v)], label) for k, v, label in rows]
    expected, links = brute(rows)
    got, by = run(spark, rows), {}
    for r in expected:
        by[r[0]] = r
    assert all(r[1] <= by[r[0]][1] for r in got), "no link below the limit"
    assert sum(r[1] for r in got) >= 0.95 * len(links) > 300


def test_codes_are_balanced():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 32)) @ rng.standard_normal((32, 32)) + 2
    codes = quantised.Codes(x[:2000].tolist())
    parts = codes.parts(x)
    assert parts.shape == (3000, 6) and parts.dtype == np.uint16
    bits = np.unpackbits(parts.view(np.uint8), axis=1).mean(0)
    assert (abs(bits - 0.5) < 0.2).all()
    learned = sum(abs(abs(((quantised._unit(x) - codes.mean) @ a)) - abs(((quantised._unit(x) - codes.mean) @ a)).mean()).sum() for a in codes.axes)
    assert learned > 0 and quantised.Codes([]).length == 0 and quantised.Codes([]).parts(np.ones((2, 3))).shape == (2, 3)


def test_no_rows(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, 1)]) == [("1", 0, 1, True)]
    with pytest.raises(ValueError):
        run(spark, [], part=17)
