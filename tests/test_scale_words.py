"""What tables of words cost: texts are cut once, runs are found a batch at a time, few words are named to the scan."""

import random

import pytest
from pyspark.sql import functions as F

from logsieve.functions.runs import ROWS_AT_ONCE
from logsieve.operators import terms
from logsieve.operators.positions import PositionIndex, position_table
from logsieve.operators.terms import TermDictionary
from logsieve.operators.textindex import TokenIndex, token_table


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rng, path = random.Random(8), str(tmp_path_factory.mktemp("words") / "d")
    texts = [None, "", "...", "Été été x_1 X_1"] + [" ".join(rng.choices("ab ba alpha beta Alpha gamma9".split(), k=rng.randint(0, 30))) for _ in range(400)]
    rows = [(i // 2 if i % 50 else None, t) for i, t in enumerate(texts)]  # keys that come twice, and none
    spark.createDataFrame(rows, "doc_id long, content string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def expected(docs):
    return [(r.doc_id, ["".join(c if c.isalnum() or c == "_" else " " for c in r.content.lower()).split()]) for r in docs.collect() if r.content is not None]


def test_positions_are_found_without_loops_in_a_row(docs):
    assert plan(position_table(docs)).count("regexp_extract_all") == 1 and "lambda" not in plan(position_table(docs))
    rows = [(w, key, [i for i, x in enumerate(words) if x == w]) for key, (words,) in expected(docs) for w in set(words)]
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in position_table(docs).collect())


@pytest.mark.parametrize("marked", [False, True])
def test_words_are_counted_without_loops_in_a_row(docs, marked):
    table = token_table(docs, mark_documents=marked)
    assert plan(table).count("regexp_extract_all") == 1 and "lambda" not in plan(table)
    rows = [(w, key, words.count(w), len(words)) for key, (words,) in expected(docs) for w in set(words)]
    rows += [("", key, 0, len(words)) for key, (words,) in expected(docs) if marked]
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in table.collect())


def test_long_texts_pass_in_parts(spark):
    words = [f"w{i}" for i in range(ROWS_AT_ONCE + 5)]
    rows = spark.createDataFrame([(1, " ".join(words + words[:2]))], "doc_id long, content string")
    found = {r.token: r.at for r in position_table(rows).collect()}
    assert len(found) == len(words) and found["w1"] == [1, len(words) + 1]


def test_tasks_sort_a_bounded_number_of_rows(docs, tmp_path, monkeypatch):
    from logsieve.operators import positions, textindex

    assert max(positions.ROWS_PER_FILE, textindex.ROWS_PER_FILE, terms.ROWS_PER_FILE) <= 1_000_000
    monkeypatch.setattr(positions, "ROWS_PER_FILE", 100)
    index = PositionIndex.ensure(docs, str(tmp_path / "p"))
    assert len(index.postings.inputFiles()) > 5


def test_few_words_of_a_pattern_need_no_join(docs, tmp_path, monkeypatch):
    index = TokenIndex.ensure(docs, str(tmp_path / "i"))
    dictionary = TermDictionary.ensure(index, str(tmp_path / "t"), "one")
    for pattern, test in (("*a", lambda w: w.endswith("a")), ("a*", lambda w: w.startswith("a")), ("none*", lambda w: False)):
        keys = {key for key, (words,) in expected(docs) if any(map(test, words))}
        monkeypatch.setattr(terms, "MOST_WORDS", 2000)
        few = dictionary.keys(pattern)
        assert "Join" not in plan(few)
        monkeypatch.setattr(terms, "MOST_WORDS", 0)
        for found in (few, dictionary.keys(pattern)):
            rows = [r.doc_id for r in found.collect()]
            assert set(rows) == keys and len(rows) == len(keys)
