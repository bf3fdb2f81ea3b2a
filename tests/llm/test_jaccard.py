import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logsieve.llm import graphs, jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, n=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows):
    """{row: (shingles, smallest key of its component)}."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted((str(k), len(s), str(least.get(find(i)) if s else k)) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def corpus(seed, copies):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 4)
    rows = []
    for _ in range(40):
        base = [word() for _ in range(rng.choice([3, 5, 6, 30, 60, 120]))]
        for _ in range(rng.choice([1, 1, 1, copies])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text))
    shared = " ".join(word() for _ in range(25))
    rows += [shared + " " + " ".join(word() for _ in range(80)) for _ in range(30)]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,batch", [(1, 1_000_000), (2, 200), (3, 50)])
def test_components(spark, monkeypatch, seed, batch):
    monkeypatch.setattr(jaccard, "BATCH", batch)
    rows = corpus(seed, 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.groups(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == brute(rows)


EDGES = [(7, ""), (3, None), (9, " \n"), (5, "one two"), (4, "ONE\ttwo"), (6, "two one"), (2, "É a b c d e"), (1, "é a b c d e"),
         (8, "w " * 3000), (None, "one two"), (None, None), (5, "one two"), (11, "a b c d e f g h i j k l"), (11, "quite other words here now and then")]


def test_edges(spark):
    docs = spark.createDataFrame([(k, t, "x", 1, b"y") for k, t in EDGES], "doc_id long, text string, digest string, n int, row binary")
    got = jaccard.groups(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == brute(EDGES)
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        (str(k), str(t)) for k, t in [(7, ""), (3, None), (9, " \n"), (None, None), (4, "ONE\ttwo"), (6, "two one"), (2, EDGES[6][1]),
                                      (1, EDGES[7][1]), (8, EDGES[8][1]), EDGES[12], EDGES[13]])


def test_keyless_group_keeps_one(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "A b  c"), (None, "")], "doc_id long, text string")
    assert sorted(len(r.text) for r in jaccard.representatives(docs).collect()) in ([0, 5], [0, 6])


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.groups(docs).collect() == [] and jaccard.representatives(docs).collect() == []


@given(st.text(alphabet="aB \t\x0bé\x1c", max_size=60))
@settings(max_examples=200, deadline=None)
def test_shingles(text):
    assert len(jaccard.shingles(text)) == len(grams(text))


@pytest.mark.parametrize("edges", [[], [(i + 1, i) for i in range(60)], [(i, 0) for i in range(1, 60)], [(1, 2), (2, 1), (3, 3), (9, 4), (4, 1), (8, 7)]])
def test_graph(spark, edges):
    parent = {}
    for a, b in edges:
        if a != b:
            for x in (a, b):
                parent.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and parent[a] != parent[b]:
                parent[a] = parent[b] = min(parent[a], parent[b])
                changed = True
    got = graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.label) for r in got) == sorted(parent.items())


def test_null_and_repeated_keys_join_once(spark, monkeypatch):
    """Open classes meet their holder's text alone, however many rows share its key."""
    rng = random.Random(8)
    rows = []
    for _ in range(150):
        text = [f"w{rng.randrange(500)}" for _ in range(40)]
        for _ in range(2):
            text[rng.randrange(40)] = f"v{rng.randrange(500)}"
            rows.append((rng.choice([None, None, 7]), " ".join(text)))
    rows += [(None, rows[0][1])] * 50
    seen = []
    of = jaccard.stored

    def watched(df, name):
        out = of(df, name)
        if name == "sets":
            seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", watched)
    got = jaccard.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows)
    assert 0 < seen[0] <= len(set(rows))


def test_long_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", 50_000)
    monkeypatch.setattr(jaccard, "TASK_GRAMS", 100_000)
    rng = random.Random(9)
    base = [f"w{rng.randrange(100_000)}" for _ in range(20_000)]
    rows = []
    for i in range(12):
        text = list(base)
        for at in range(i * 37, 20_000, 400):
            text[at] = f"x{rng.randrange(100_000)}"
        rows.append((i, " ".join(text)))
    got = jaccard.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows)


def test_representatives_with_clashing_columns(spark):
    rows = [(1, "a b c d e f", "x", 1), (2, "a b c d e f", "y", 2), (None, "", "z", 3), (None, None, "z", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row string, __kept int")
    out = jaccard.representatives(docs)
    assert out.columns == docs.columns and sorted(r[3] for r in out.collect()) == [1, 3, 4]
