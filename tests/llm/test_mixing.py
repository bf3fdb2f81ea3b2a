import re

import pytest

from logsieve.llm import mixing
from logsieve.llm.common import WORD

ROWS = [(1, "a b c", "x"), (2, "d  e", "x"), (3, "", "x"), (4, None, "y"), (5, "f " * 700, "y"), (6, "g", None), (7, "h i j k", "é"),
        (8, "w " * 300, "z"), (8, "w " * 300, "z"), (None, "n n", "z"), (9, " ", "only empty")]


def size(text):
    return len(re.findall(WORD, text or ""))


def plan(rows, weights=(1, 2, 3), most=3):
    """Targets by rounds of resharing, seats one at a time."""
    order = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(t) for _, t, x in rows if x == s) for s in order}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(total.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= most * total[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = float(most * total[s])
            left -= target[s]
            open_.remove(s)
    least = min((t for t in target.values() if t > 0), default=1)
    block = max(1, min(mixing.BLOCK_WORDS, int(least // 64)))
    seats = dict.fromkeys(order, 0)
    for _ in range(int(sum(target.values()) // block)):
        free = [s for s in order if seats[s] < most * total[s] // block]
        if not free:
            break
        seats[max(free, key=lambda s: (target[s] / (2 * seats[s] + 1), -order.index(s)))] += 1
    return total, target, {s: n * block for s, n in seats.items()}


def check(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, source string, taken double").repartition(3)
    got = mixing.mix(docs, **options).collect()
    total, target, dealt = plan(rows)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(k), size(t)) for k, t, _ in rows)
    for s in total:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == total[s] and r.target == pytest.approx(target[s]) for r in mine)
        assert sum(r.taken for r in mine) == dealt[s]
        assert abs(dealt[s] - target[s]) <= max(1, target[s] / 32)
        assert all(r.taken == r.rounds * r.size + r.part and r.taken <= 3 * r.size for r in mine)
    assert all((r.shard is None) == (r.taken == 0) for r in got)
    return sorted(tuple(map(str, r)) for r in got)


def test_mix(spark):
    once = check(spark, ROWS)
    assert check(spark, ROWS) == once, "reruns agree"
    many = [(i, f"w{i} " * (i % 37), f"s{i % 23}" if i % 3 else "hot") for i in range(900)]
    assert {r[-1] for r in check(spark, many, shards=1)} <= {"0", "None"}
    assert {r[7] for r in map(tuple, check(spark, many, shards=5))} == {r[7] for r in map(tuple, check(spark, many, shards=1))}


def test_quotas_grow_by_shard(spark):
    totals = spark.createDataFrame([("a", 1000), ("b", 3000), ("c", 10)], "source string, source_size long")
    rows = mixing.quotas(mixing.targets(totals, mixing.cyclic_weights(totals)), shards=4).collect()
    seats = [sum(r.dealt[h] for r in rows) for h in range(4)]
    whole = int(sum(r.target for r in rows) // rows[0].block)
    assert seats == [whole * (h + 1) // 4 for h in range(4)] and all(r.dealt == sorted(r.dealt) for r in rows)


def test_mixed_documents(spark):
    docs = spark.createDataFrame([(k, t, s, len(t or ""), 5) for k, t, s in ROWS], "doc_id long, text string, source string, n_chars long, rounds int")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert all(r.n_chars == len(r.text) and r.rounds == 5 for r in got)
    taken = {}
    for r in mixing.mix(docs).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    words = {}
    for r in got:
        words[r.source] = words.get(r.source, 0) + size(r.text)
    assert {s: n for s, n in taken.items() if n and s != "z"} == {s: n for s, n in words.items() if s != "z"}
    texts = {(k, s): t for k, t, s in ROWS}
    assert all(texts[r.doc_id, r.source].startswith(r.text) for r in got)


def test_no_rows_and_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).collect() == [] and mixing.mixed_documents(docs).collect() == []
    rows = mixing.mix(spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_mixed_documents_with_equal_keys(spark):
    rows = [*ROWS, *[(None, f"{c} n", "z") for c in "abcdef"], *[(8, f"{c} " * 300, "z") for c in "vu"], *[(None, f"{i} z z", None) for i in range(9)]]
    rows += [(i, "x " * 40, "x") for i in range(20, 30)] * 2
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, n long").repartition(3)
    for weights in ((1, 2, 3), (9, 1, 1)):
        of = mixing.cyclic_weights(docs.select("source").distinct(), weights)
        taken, words, copies = {}, {}, {}
        for r in mixing.mix(docs, weights=of).collect():
            taken[r.source] = taken.get(r.source, 0) + r.taken
        for r in mixing.mixed_documents(docs, weights=of).collect():
            words[r.source] = words.get(r.source, 0) + size(r.text)
            copies[r.doc_id, r.text, r.source] = copies.get((r.doc_id, r.text, r.source), 0) + 1
        assert {s: n for s, n in taken.items() if n} == words
        assert all(n <= 3 * max(1, rows.count(k)) for k, n in copies.items())


def test_one_key_is_dealt_over_buckets(spark, monkeypatch):
    rows = [(None, f"word{i} more", "hot") for i in range(2000)] + [(7, f"w{i}", "hot") for i in range(500)] + [(3, "same row", "hot")] * 900
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "ALIKE", 100)
    sized = mixing.sizes(docs)
    got = sorted((r.first, r.size) for r in mixing.deck(sized).collect())
    assert len(got) == len(rows) and all(a + n == b for (a, n), (b, _) in zip(got, got[1:]))
    check(spark, rows)
