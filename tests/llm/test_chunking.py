import random

import duckdb
import numpy as np
import pytest

from logsieve.llm import chunking

LEAST = chunking.LEAST_WORDS


def words(rng, n):
    return [rng.choice("bcdfg") + str(rng.randrange(3000)) for _ in range(n)]


def cut(text):
    return "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if text else []


def tokens(text):
    return [w for w in cut(text) if w]


def order(row):
    return (row[0] is not None, row[0] or 0)


def windows(rows, n=LEAST):
    """{n words: the first key that has them}, without any chunk: every window of every document."""
    first = {}
    for key, text in sorted(set(rows), key=order):
        w = tokens(text)
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), (key, text))
    return first


def check(rows, found):
    """Each passage stands, in one piece, at the place of the earlier document that its row names."""
    texts = {}
    for key, text in rows:
        texts.setdefault(key, []).append(tokens(text))
    earlier = windows(rows)
    for r in found:
        assert r.n_words >= LEAST and order((r.first_doc_id, 0)) <= order((r.doc_id, 0))
        own = [w[r.start_word : r.start_word + r.n_words] for w in texts[r.doc_id]]
        other = [w[r.first_start_word : r.first_start_word + r.n_words] for w in texts[r.first_doc_id]]
        assert any(a == b and len(a) == r.n_words for a in own for b in other)
        assert any(earlier.get(tuple(a[:LEAST]), (r.doc_id, None))[0] != r.doc_id or r.doc_id == r.first_doc_id for a in own)


def frame(spark, rows):
    return spark.createDataFrame([(k, t, k) for k, t in rows], "doc_id long, text string, digest long").repartition(4)


def test_chunks_cover_the_text_and_resist_shifts():
    rng = random.Random(1)
    text = words(rng, 400)
    found = chunking.chunks(" ".join(text))
    at = 0
    for _, first, n in found:
        assert first == at and n <= chunking.LONGEST + chunking.SHORTEST and (n >= chunking.SHORTEST or at + n == len(text))
        at += n
    assert at == len(text)
    moved = chunking.chunks("some words before " + "\n".join(text))
    same = {d for d, _, _ in found} & {d for d, _, _ in moved}
    assert len(same) >= len(found) - 4
    assert chunking.chunks(None) == chunking.chunks("") == chunking.chunks("  \n") == []
    assert len(chunking.chunks("same " * 100_000)) > 0


def test_chains_are_the_same_wherever_they_stand():
    rng = random.Random(2)
    passage = words(rng, 300)
    a, b = (chunking.chains(" ".join(words(rng, n) + passage + words(rng, 50))) for n in (7, 460))
    shared = set(a["digest"].tolist()) & set(b["digest"].tolist())
    inside = [(d, s, n) for d, s, n in zip(a["digest"].tolist(), a["start"], a["words"], strict=True) if s >= 20 and s + n <= 295]
    assert inside and all(d in shared for d, _, _ in inside) and (a["words"] >= LEAST).all()
    assert len(chunking.chains(None)["digest"]) == len(chunking.chains("a few words only")["digest"]) == 0
    long = chunking.chains("one two three four five six seven " * 20_000)
    assert len(long["digest"]) > 10_000 and len(np.unique(long["digest"])) < 60


def corpus():
    rng = random.Random(5)
    passages = [words(rng, n) for n in (60, 80, 55, 20, 9)]
    rows = [(i, " ".join(words(rng, 150))) for i in range(30)]
    for i in range(30, 90):
        text = words(rng, 120)
        for p in rng.sample(passages, 2):
            at = rng.randrange(len(text))
            text[at:at] = p
        rows.append((i, " ".join(text)))
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, ""), (203, None), (None, rows[40][1]), (1, rows[1][1])]
    return rows, passages


def test_passages(spark, monkeypatch):
    rows, planted = corpus()
    answers = []
    for batch in (400_000, 100):
        monkeypatch.setattr(chunking, "BATCH_CHAINS", batch)
        got = chunking.passages(frame(spark, rows)).collect()
        check(rows, got)
        answers.append(sorted(map(str, got)))
    assert answers[0] == answers[1]
    flagged = {r.doc_id for r in got}
    assert not flagged & set(range(30)), "documents without repeats stay alone"
    for passage in planted[:3]:
        holders = [k for k, t in rows if t and " ".join(passage) in t and k is not None]
        assert set(holders) - {None} <= flagged | {min(holders)}
    whole = [r for r in got if r.doc_id in (200, 201)]
    assert len(whole) == 2 and all(r.first_doc_id == 0 and r.n_words == 150 and r.start_word == 0 for r in whole)


@pytest.mark.parametrize("phrases", [60, 300, 3000])
def test_text_stitched_of_common_phrases(spark, phrases):
    """Nearly every chunk occurs in an earlier document, hardly any run of 24 words does."""
    rng = random.Random(phrases)
    common = [words(rng, 9) for _ in range(phrases)]
    rows = [(i, " ".join(w for _ in range(40) for w in rng.choice(common))) for i in range(200)]
    got = chunking.passages(frame(spark, rows)).collect()
    check(rows, got)
    earlier = windows(rows)
    cuts = [(k, tokens(t)) for k, t in rows]
    true = sum(earlier[tuple(w[i : i + LEAST])][0] != k for k, w in cuts for i in range(len(w) - LEAST + 1))
    assert len(got) <= true, "no passage without a repeated window"
    kept = {r.doc_id: r.text for r in chunking.without_repeats(frame(spark, rows)).select("doc_id", "text").collect()}
    gone = sum(len(tokens(t)) - len(tokens(kept.get(k))) for k, t in rows)
    assert gone <= sum(r.n_words for r in got)


def test_given_documents(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    got = chunking.passages(frame(spark, rows)).collect()
    assert got
    check(rows, got)


def test_without_repeats(spark):
    rows, planted = corpus()
    docs = spark.createDataFrame([(k, t, len(t or ""), "s") for k, t in rows], "doc_id long, text string, n_chars long, _key string")
    out = chunking.without_repeats(docs)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text, r.n_chars) for r in out.collect()]
    assert all(n == len(t or "") for _, t, n in kept)
    before = dict(rows)
    assert all(t == before[k] for k, t, _ in kept if k in range(30) and k is not None and k != 0)
    assert {200, 201} & {k for k, _, _ in kept} == set(), "copies go as a whole"
    for passage in planted[:3]:
        assert sum(" ".join(passage[12:-12]) in (t or "") for _, t, _ in kept) == 1
    assert any(k == 203 and t is None for k, t, _ in kept)
    assert chunking.without("a b  c\nd e f g", [(2, 2), (5, 1)]) == "a b  e g"
    assert chunking.without("a b  c\nd e f g", [(1, 3), (2, 3), (2, 1)]) == "a f g"


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert chunking.passages(docs).collect() == [] and chunking.without_repeats(docs).collect() == []


def test_repetitive_passages(spark):
    rng, rows = random.Random(3), []
    for i in range(240):
        n, line = rng.randint(51, 100), words(rng, i % 6 + 1)
        passage = (line * n)[:n]
        if i % 6 == 5:
            passage = [w for r in range(n) for w in ("|", str((r * r + i) % 10), "|", "0", "|")][:n]
        for key in (2 * i, 2 * i + 1):
            before, after = words(rng, rng.randint(20, 90)), words(rng, 40)
            rows.append((key, " ".join(before + passage + after)))
    got = chunking.passages(frame(spark, rows)).collect()
    check(rows, got)
    assert {2 * i + 1 for i in range(240)} <= {r.doc_id for r in got}
