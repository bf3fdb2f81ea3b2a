"""Block maxima against full scoring, bitmaps against the clauses that read texts."""

import random

import pytest
from pyspark.sql import functions as F

from logsieve.operators import blockmax
from logsieve.operators.bitmaps import BitmapIndex, Words
from logsieve.operators.blockmax import BlockIndex
from logsieve.operators.clauses import compound, text
from logsieve.operators.facets import facet
from logsieve.operators.relevance import rank
from logsieve.operators.search import search

WORDS = ["alpha", "beta", "gamma", "delta", "omega", "rare"]


def sentence(rng, place):
    """Words whose frequency changes with the place, as in a collection that is in order of time."""
    weights = [9, 7, 5, 3, 2, 0.2 if place % 100 < 10 else 0.01]
    return None if rng.random() < 0.03 else " ".join(rng.choices(WORDS, weights, k=rng.randint(0, 40)))


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rng, path = random.Random(3), str(tmp_path_factory.mktemp("docs") / "d")
    rows = [(i * 3 - 500, sentence(rng, i), rng.choice(["x", "y", None]), "t") for i in range(1500)]
    spark.createDataFrame(rows, "doc_id long, content string, kind string, block string").withColumn(
        "metadata", F.struct(F.col("kind").alias("type"))).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("block_docs", [16, 400])
def test_the_best_are_those_of_full_scoring(spark, docs, tmp_path, monkeypatch, block_docs):
    index = BlockIndex.ensure(docs, str(tmp_path / "b"), block_docs=block_docs)
    for named in (5000, 2):
        monkeypatch.setattr(blockmax, "MOST_NAMED", named)
        for query, limit in (("rare", 5), ("rare omega", 20), ("alpha", 10), ("alpha beta rare", 3), ("rare", 1000), ("nothing", 4)):
            expected = [(r.doc_id, round(r.score, 9)) for r in rank(docs, query, limit).collect()]
            assert [(r.doc_id, round(r.score, 9)) for r in index.rank(query, limit).collect()] == expected, (query, limit)
    with pytest.raises(ValueError):
        index.rank("alpha", 0)


def test_few_blocks_are_scored(spark, docs, tmp_path):
    index = BlockIndex.ensure(docs, str(tmp_path / "b"), block_docs=16)
    read = index.read("rare alpha", 3).first()
    assert 0 < read.scored < 0.5 * read.blocks and read.scored_postings < read.postings
    strings = docs.withColumn("doc_id", F.concat(F.lit("k"), F.col("doc_id").cast("string")))
    by_text = BlockIndex.ensure(strings, str(tmp_path / "s"), block_docs=16)
    assert [round(r.score, 9) for r in by_text.rank("rare alpha", 7).collect()] == [round(r.score, 9) for r in rank(docs, "rare alpha", 7).collect()]
    none = BlockIndex.ensure(docs.filter("doc_id is null"), str(tmp_path / "n"))
    assert none.rank("alpha", 3).collect() == []


CLAUSES = [
    (Words("rare"), lambda: compound(filter=[text("content", "rare")])),
    (Words("rare omega"), lambda: compound(filter=[text("content", "rare omega")])),
    (Words("alpha") & Words("omega"), lambda: compound(filter=[text("content", "alpha omega", "all")])),
    (~Words("alpha"), lambda: compound(filter=[text("content", "beta alpha gamma delta omega rare")], must_not=[text("content", "alpha")])),
    (Words("omega") & ~(Words("alpha") | Words("rare")), lambda: compound(filter=[text("content", "omega")], must_not=[text("content", "alpha rare")])),
    (Words("nothing"), lambda: compound(filter=[text("content", "nothing")])),
]


@pytest.fixture(scope="module")
def bitmaps(docs, tmp_path_factory):
    return BitmapIndex.ensure(docs, str(tmp_path_factory.mktemp("bitmaps") / "b"))


@pytest.mark.parametrize("number", range(len(CLAUSES)))
def test_bitmaps_answer_as_texts_do(docs, bitmaps, number):
    clause, plain = CLAUSES[number][0], CLAUSES[number][1]()
    empty = docs.filter("content = ''").count() if number == 3 else 0
    expected = sorted(r.doc_id for r in search(docs, plain).collect())
    if number == 3:  # texts without any word are hits of a negation
        expected = sorted([*expected, *(r.doc_id for r in docs.filter("content = ''").collect())])
    assert sorted(r.doc_id for r in bitmaps.keys(clause).collect()) == expected
    assert bitmaps.count(clause).first()["hits"] == len(expected)
    if not empty:
        found = {tuple(r) for r in bitmaps.facet(clause, "metadata.type").collect()}
        rows = facet(docs, plain, "metadata.type").collect()
        assert found == {(r["bucket"], r["is_total"], r["n"]) for r in rows if r["is_total"] or r["bucket"] is not None}


def test_bitmaps_of_no_documents(spark, docs, tmp_path):
    index = BitmapIndex.ensure(docs.filter("doc_id is null"), str(tmp_path / "b"), facets=())
    assert index.count(~Words("alpha")).first()["hits"] == 0 and index.keys(Words("alpha")).collect() == []
    assert index.facet(Words("alpha"), "metadata.type").collect() == []
    with pytest.raises(ValueError):
        Words(" - ")
