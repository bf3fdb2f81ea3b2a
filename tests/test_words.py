"""The standard rule for words, words by pattern, and stored sketches."""

import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from logsieve.functions.text import has_words, query_words, tokens
from logsieve.operators import report
from logsieve.operators.clauses import text
from logsieve.operators.relevance import corpus_stats
from logsieve.operators.search import search
from logsieve.operators.sketches import RANK_ERROR, Sketches, sketch_table
from logsieve.operators.terms import TermDictionary, front, rotations
from logsieve.operators.textindex import TokenIndex

# Examples of the standard and of its neighbourhood: where words end.
EXAMPLES = {
    "The quick (“brown”) fox can’t jump 32.3 feet, right?": "the quick brown fox can’t jump 32.3 feet right",
    "Can't stop, won't stop": "can't stop won't stop", "example.com and a.b.c": "example.com and a.b.c", "3.14 1,234.5 1;2": "3.14 1,234.5 1;2",
    "a:b x·y": "a:b x·y", "end. 'quoted' .5 5. a,b 3.x x.3": "end quoted 5 5 a b 3 x x 3", "a_b __x__ _ __": "a_b __x__",
    "192.168.0.1:80": "192.168.0.1 80", "foo-bar foo/bar": "foo bar foo bar", "naïve éte's": "naïve éte's", "été": "été",
    "日本語": "日 本 語", "カタカナ ー": "カタカナ ー", "ひら": "ひ ら", "ab日": "ab 日", "א״ב": "א״ב", "": "", "…!?": "", "a..b a''b": "a b a b",
}


def test_published_examples(spark):
    rows = spark.createDataFrame(list(EXAMPLES.items()), "t string, expected string")
    got = rows.select("t", "expected", F.array_join(tokens(F.col("t"), "standard"), " ").alias("words")).collect()
    assert {r.t: r.words for r in got} == EXAMPLES
    for t, words in EXAMPLES.items():
        if words:
            assert " ".join(query_words(t, "standard")) == words
    with pytest.raises(ValueError):
        query_words("__ !", "standard")
    with pytest.raises(ValueError):
        tokens(F.col("t"), "other")


def test_both_readers_agree_and_long_texts_need_no_stack(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abÉ12.,':_ -日カ́’ß") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    texts += ["a." * 200_000 + "b", "1," * 200_000 + "2", "_a1" * 100_000]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", tokens(F.col("t"), "standard").alias("w")).collect()
    for r in got:
        try:
            expected = query_words(texts[r.i], "standard")
        except ValueError:
            expected = []
        assert r.w == expected


ROWS = [(1, "see example.com now"), (2, "example and com"), (3, "Don't 3.14"), (4, "don t 3 14"), (5, None), (6, ""), (7, "EXAMPLE.COM don't")]


def test_search_by_the_standard_rule(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, content string")
    keys = lambda rows: sorted(r.doc_id for r in rows.collect())
    assert keys(search(docs, text("content", "example.com", rule="standard"))) == [1, 7] and keys(search(docs, text("content", "example.com", mode="all"))) == [1, 2, 7]
    assert keys(docs.filter(has_words(F.col("content"), "example.com don't", "all", "standard"))) == [7]
    TokenIndex.of(docs, rule="standard").save(str(tmp_path / "i"))
    docs.write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    index = TokenIndex.ensure(stored, str(tmp_path / "v"), rule="standard")
    assert keys(index.keys("3.14 don't", "all")) == [3] and keys(index.matching(stored, "Example.Com")) == [1, 7]
    other = TokenIndex.ensure(stored, str(tmp_path / "v"))
    assert keys(other.keys("3.14 don't", "all")) == [3, 4]
    scored = search(stored, text("content", "don't", stats=corpus_stats(stored, "don't", rule="standard"), rule="standard"), score=True)
    assert {r.doc_id: round(r.score, 9) for r in scored.collect()} == {r.doc_id: round(r.score, 9) for r in index.rank("don't").collect()}


WORDS = ["license", "licence", "licensing", "gnu", "foundation", "a", "ab", "aab", "x_y", "100", "été", "under_score", "percent"]


@pytest.mark.parametrize("pattern", ["licen?e", "licen*", "*ion", "*und*", "l*s*", "*", "?", "a*b", "a?b", "*_*", "LIC*", "é*é", "?n?", "zzz*", "gnu", "1??", "*a*b*"])
def test_words_by_pattern(spark, tmp_path, pattern):
    docs = spark.createDataFrame([(i, f"{w} {WORDS[i * 7 % len(WORDS)]}") for i, w in enumerate(WORDS)], "doc_id long, content string")
    index = TokenIndex.of(docs)
    rows = rotations(index.postings.select("token").distinct())
    found = TermDictionary(rows, index)
    expected = sorted(w for w in WORDS if fnmatch.fnmatchcase(w, pattern.lower()))
    assert sorted(r.token for r in found.words(pattern).collect()) == expected
    holders = sorted(i for i, w in enumerate(WORDS) if {w, WORDS[i * 7 % len(WORDS)]} & set(expected))
    assert sorted(r.doc_id for r in found.keys(pattern).collect()) == holders


def test_ranges_of_the_dictionary(spark, tmp_path):
    assert [front(p) for p in ("licen?e*", "*und*", "w*n?y", "*", "gnu", "ab*")] == ["|licen", "und", "y|w", "|", "gnu|", "|ab"]
    docs = spark.createDataFrame([(1, "under wonder")], "doc_id long, content string")
    TokenIndex.of(docs).save(str(tmp_path / "i"))
    found = TermDictionary.ensure(TokenIndex.load(spark, str(tmp_path / "i")), str(tmp_path / "t"), "one")
    plan = found.words("*nde*")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rotation,nde), StringStartsWith" in plan and sorted(r.token for r in found.words("*nde*").collect()) == ["under", "wonder"]
    for bad in ("", "a|b"):
        with pytest.raises(ValueError):
            found.words(bad)


def test_sketches(spark, tmp_path):
    rows = spark.range(60_000).select(F.expr("if(id % 3 < 2, 'hot', concat('n', id % 7))").alias("name"), F.expr("date_add(date'2024-01-01', int(id % 40))").alias("day"),
                                      F.expr("if(id % 11 = 0, null, exp((id * 7919 % 10007) / 1500.0))").alias("ms"))
    rows.write.parquet(str(tmp_path / "s"))
    samples = spark.read.parquet(str(tmp_path / "s"))
    sketches = Sketches.ensure(samples, str(tmp_path / "k"))
    wanted = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    for first, last in ((None, None), ("2024-01-10", "2024-02-01")):
        part = samples.filter("ms is not null")
        if first:
            part = part.filter(f"day between date'{first}' and date'{last}'")
        got = {r["name"]: r for r in sketches.quantiles(wanted, first, last).collect()}
        exact = {r["name"]: r for r in part.groupBy("name").agg(F.count("ms").alias("n"), F.sort_array(F.collect_list("ms")).alias("v")).collect()}
        assert set(got) == set(exact)
        for name, r in got.items():
            assert r.n == exact[name].n
            for q, share in wanted.items():
                v = exact[name].v
                low, high = sum(x < r[q] for x in v), sum(x <= r[q] for x in v)
                assert low - RANK_ERROR * r.n - 1 <= share * r.n <= high + RANK_ERROR * r.n + 1
    assert sketches.quantiles(wanted, "2030-01-01").collect() == []
    assert sketches.rows.count() == sketch_table(samples).count() and report.percentiles(samples.limit(0)).collect() == []
