import hashlib

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from logsieve.llm import phrases


def plain(text):
    """LZ78 phrases, one character at a time."""
    seen, ends, start = set(), [], 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.add(text[start:end])
            ends.append(end)
            start = end
    return ends


@given(st.text(alphabet="ab日c", max_size=200), st.integers(0, 200), st.text(alphabet="ab", max_size=40))
@settings(max_examples=300, deadline=None)
def test_parse(text, cut, other):
    parse = phrases.Parse()
    state = parse.run(text, min(cut, len(text)))
    assert parse.ends == plain(text)
    edited = text[: min(cut, len(text))] + other
    state.run(edited)
    assert state.ends == plain(edited)


def test_likeness():
    of = lambda t: phrases.signature(t, plain(t))
    assert phrases.likeness(of(""), of("")) == 1 and phrases.likeness(of(""), of("a")) == 0
    a, b = of("abcabcabd" * 5), of("abcabcabd" * 5 + "xyz")
    assert phrases.likeness(a, a) == 1
    assert phrases.likeness(a, b) == len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    rng = np.random.default_rng(3)
    x, y = np.unique(rng.integers(0, 1 << 32, 600, np.uint32)), np.unique(rng.integers(0, 1 << 32, 600, np.uint32))
    x = np.union1d(x, y[:300])
    k = phrases.KEPT
    least = np.union1d(x, y)[:k]
    assert phrases.likeness(x[:k], y[:k]) == np.isin(least, np.intersect1d(x, y)).mean()


TEXTS = ["", None, "one two one two three", "a", "same words here", "same words here", "Grüße 日本 \U0001f600 ende", "lorem ipsum " * 400] + [f"text {i} with some words {i * i}" for i in range(30)]


def spark_hash(text):
    """xxhash64 of a column; 42, its seed, for a null."""
    return 42 if text is None else np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).astype(np.int64).item()


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), spark_hash(r[1]), r[1] or ""))
    out = []
    for (key, text), (_, other) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, other = text or "", other or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        of = [phrases.signature(t, plain(t)) for t in (text, edited, other)]
        out.append((str(key), len(text), hashlib.sha256(edited.encode()).hexdigest(), phrases.shown(of[0]), phrases.shown(of[1]), phrases.likeness(of[0], of[1]), phrases.likeness(of[0], of[2])))
    return sorted(out)


def check(spark, rows, **options):
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n_chars int").repartition(4)
    got = phrases.edited_likeness(docs, **options).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == brute(rows)


def test_neighbours(spark):
    rows = [(i * 37 % 101, t) for i, t in enumerate(TEXTS)]
    check(spark, rows, run_chars=100)
    check(spark, rows)


def test_ties_nulls_and_single_rows(spark):
    check(spark, [(5, "b c d"), (5, "a b c d e"), (None, "null key"), (None, None), (9, "x y z"), (1, "last text")])
    check(spark, [(3, "only one text")])
    check(spark, [(None, "a b"), (None, "c d e f")])
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert phrases.edited_likeness(docs).collect() == []


def test_fingerprints(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in phrases.fingerprints(docs).collect()}
    assert got == {i: phrases.shown(phrases.signature(t or "", plain(t or ""))) for i, t in enumerate(TEXTS)}


def test_one_key_for_many_rows(spark):
    """Rows without a key, or all with one, are cut into runs by the hash of their text."""
    for key in (None, 7):
        rows = [(key, f"text {i} with some words {i * i}") for i in range(300)] + [(i, f"other {i}") for i in range(100)]
        check(spark, rows, run_chars=400)
    counts = phrases._starts([7] * 20 + [9], 9, 500, 10.0)
    assert len([c for c in counts if c[0]]) == 50 and len([c for c in counts if c[:2] == (0, ~7)]) == 20 and counts == sorted(counts)
