"""An index of segments answers as one that was built anew, and changes only what is new."""

import os
import random

import pytest

from logsieve.operators.positions import PositionIndex
from logsieve.operators.relevance import rank
from logsieve.operators.search import search
from logsieve.operators.clauses import text
from logsieve.operators.segments import SegmentedIndex
from logsieve.operators import positions
from logsieve.operators.textindex import TokenIndex

WORDS = ["alpha", "beta", "gamma", "delta", "omega", "rare"]


def sentence(rng):
    return None if rng.random() < 0.05 else " ".join(rng.choices(WORDS, [9, 7, 5, 3, 2, 0.3], k=rng.randint(0, 30)))


def frame(spark, rows):
    return spark.createDataFrame([(t, k, "x") for k, t in rows], "content string, doc_id long, token string").coalesce(1)


def answers(index):
    scores = {q: sorted((r.doc_id, round(r.score, 9)) for r in index.rank(q).collect()) for q in ("rare", "alpha omega")}
    keys = {(q, m): sorted(r.doc_id for r in index.keys(q, m).collect()) for q in ("rare gamma",) for m in ("any", "all")}
    return scores, keys, [(r.n, r.words) for r in index.corpus.collect()]


def files(index):
    return {s.folder: sorted((f, os.stat(os.path.join(d, f)).st_mtime_ns) for d, _, names in os.walk(s.folder) for f in names)
            for s in (*index.segments, *index.deleted)}


def test_any_changes_equal_a_rebuild(spark, tmp_path):
    rng, live, index = random.Random(1), {}, SegmentedIndex(spark, str(tmp_path / "i"), fanout=3, smallest=1)
    for step in range(7):
        before, kind = files(index), rng.choice(["append", "update", "delete"]) if step > 1 else "append"
        if kind == "append":
            rows = {100 * step + i: sentence(rng) for i in range(rng.choice([3, 20, 60]))}
            index.append(frame(spark, rows.items()))
            live |= rows
        elif kind == "update":
            rows = {k: sentence(rng) for k in [*rng.sample(sorted(live), min(len(live), 7)), 5000 + step]}
            index.update(frame(spark, rows.items()))
            live |= rows
        else:
            gone = [*rng.sample(sorted(live), min(len(live), 9)), 9999]
            index.delete(spark.createDataFrame([(k,) for k in (*gone, gone[0], None)], "doc_id long"))
            live = {k: t for k, t in live.items() if k not in gone}
        after = files(index)
        assert all(after[f] == before[f] for f in before if f in after), "what was written stays as it is"
        assert kind != "delete" or [s.folder for s in index.segments] == [f for f in before if "/segments/" in f]
        if step % 3 == 0:
            rebuilt = answers(TokenIndex.of(frame(spark, live.items()).coalesce(1)))
            assert answers(index.index()) == rebuilt
    assert answers(SegmentedIndex(spark, str(tmp_path / "i")).index()) == rebuilt and len(index.segments) < 7, "another reader"


def test_segments_of_a_size_are_merged(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path / "i"), fanout=3, smallest=10)
    reader = None
    for i in range(6):
        index.append(frame(spark, [(i * 10 + j, f"word{j} every") for j in range(10)]))
        if i == 3:
            index.delete(frame(spark, [(0, "")]).select("doc_id"))
            reader = SegmentedIndex(spark, str(tmp_path / "i"))
    assert len(index.segments) <= 4 and index.report().first().docs == 59
    assert index.index().keys("every").count() == 59 and index.index().keys("word0").count() == 5
    assert reader.report().first().docs == 39
    kept = {s.folder for v in index.versions.all() for kind in index._list(v.folder) for s in kind}
    assert {f"{index.path}/segments/{d}" for d in os.listdir(f"{index.path}/segments")} <= kept, "nothing that no version uses"


def test_edges(spark, tmp_path):
    index = SegmentedIndex(spark, str(tmp_path / "i"))
    with pytest.raises(ValueError):
        index.index()
    index.delete(frame(spark, [(1, "")]).select("doc_id"))
    index.append(frame(spark, []))
    assert index.report().first().docs == 0 and index.index().keys("alpha").collect() == []
    index.update(frame(spark, [(1, "alpha"), (2, None), (3, ""), (None, "alpha")]), "done")
    assert SegmentedIndex(spark, str(tmp_path / "i")).state == "done"
    assert sorted(str(r.doc_id) for r in index.index().keys("alpha").collect()) == ["1", "None"] and index.report().first().docs == 3


def places(words, query, distance=None):
    """How often the words of a query follow each other, by trying all places."""
    if distance is None:
        return sum(words[i:i + len(query)] == query for i in range(len(words)))
    reached = {i for i, w in enumerate(words) if w == query[0]}
    for q in query[1:]:
        reached = {i for i, w in enumerate(words) if w == q and any(e < i and (not distance or i - e <= distance) for e in reached)}
    return len(reached)


def test_phrases_and_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(positions, "LISTED", 3)
    rng = random.Random(7)
    rows = [(i, sentence(rng)) for i in range(120)] + [(500, "Alpha, BETA! alpha-beta alpha beta"), (501, "beta " * 3000 + "alpha"), (502, "")]
    frame(spark, rows).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    index = PositionIndex.ensure(docs, f"{tmp_path}/index")
    cut = {k: "".join(c if c.isalpha() else " " for c in (t or "").lower()).split() for k, t in rows}
    for query in (["alpha"], ["alpha", "beta"], ["alpha", "alpha"], ["alpha", "beta", "alpha"], ["nothing", "alpha"]):
        expected = {k: n for k, w in cut.items() if (n := places(w, query))}
        assert {r.doc_id: r.n for r in index.phrase(" ".join(query)).collect()} == expected, query
        for distance in (0, 2, 5):
            expected = {k: n for k, w in cut.items() if (n := places(w, query, distance))}
            assert {r.doc_id: r.n for r in index.in_order(" ".join(query), distance).collect()} == expected, (query, distance)
    assert {r.doc_id for r in index.phrase("alpha").collect()} == {r.doc_id for r in search(docs, text("content", "alpha")).collect()}
    with pytest.raises(ValueError):
        index.in_order("alpha beta", -1)


def test_one_pass_gives_the_same_statistics(spark, tmp_path):
    rng = random.Random(8)
    docs = frame(spark, [(i, sentence(rng)) for i in range(50)])
    TokenIndex.of(docs).save(f"{tmp_path}/i")
    stored = TokenIndex.load(spark, f"{tmp_path}/i")
    assert stored.corpus.collect() == TokenIndex.of(docs).corpus.collect() and stored.postings.filter("token = ''").count() == 0
    assert sorted((r[0], round(r[1], 9)) for r in stored.rank("omega rare").collect()) == sorted((r[0], round(r[1], 9)) for r in rank(docs, "omega rare").collect())
