"""Pattern search through the trigram table gives the hits of a scan."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logsieve.functions.grams import TRUE, Gram, all_of, any_of, grams_in, holds, required_grams
from logsieve.functions.patterns import compile_find, compile_whole
from logsieve.operators.clauses import find, regex
from logsieve.operators.search import hits
from logsieve.operators import trigrams
from logsieve.operators.trigrams import TrigramIndex
from logsieve.sources.documents import prose


def grams(text):
    low = text.lower()
    return {low[i:i + 3] for i in range(len(low) - 2) if low[i:i + 3].isascii()}


def g(text):
    return all_of(*(Gram(text[i:i + 3]) for i in range(len(text) - 2)))


@pytest.mark.parametrize("pattern,options,expected", [
    ("license", "", g("license")),
    ("LICENSE", "i", g("license")),
    ("licen[cs]e", "", any_of(g("license"), g("licence"))),
    ("(Exception|Error)", "", any_of(g("exception"), g("error"))),
    ("ERROR.*WARN", "", all_of(g("error"), g("warn"))),
    ("abc?d", "", any_of(g("abcd"), g("abd"))),
    ("(abc)+x", "", all_of(g("abc"), g("bcx"))),
    ("x{3}y", "", g("xxxy")),
    ("^foo$", "m", g("foo")),
    ("Straße", "i", g("tra")),
    ("a\\dbcd", "", all_of(g("bcd"), any_of(*(g(f"a{d}bcd") for d in range(10))))),
])
def test_formulas(pattern, options, expected):
    formula = required_grams(compile_find(pattern, options))
    for text in (pattern, "license LICENCE error exception warn abcd abd abcabcx xxxy foo stra a5bcd", "abd error", "x", "bcd a1b 1bc"):
        assert holds(formula, grams(text)) == holds(expected, grams(text))


@pytest.mark.parametrize("pattern", ["", "ab", "[a-z]+", ".*", "a.b.c", "foo|", "(foo)*", "(?=foo)bar", "[^a]bc", "ééé", "(a|b)(c|d)?"])
def test_patterns_without_a_trigram(pattern):
    assert required_grams(compile_find(pattern)) == TRUE


def test_whole_values():
    assert required_grams(compile_whole('(.*)"port"(.*)')) == g("port") and required_grams(compile_whole("(.*)")) == TRUE
    assert required_grams(compile_whole("ab(.*)cde")) == g("cde")


LETTERS = "abAB é"


def parts():
    return st.recursive(
        st.one_of(st.text(LETTERS, min_size=1, max_size=4), st.sampled_from([".", "[ab]", "[a-b]x", "[^a]", "a?", "b*", "[AB]+"])),
        lambda inner: st.one_of(
            st.lists(inner, min_size=1, max_size=3).map("".join),
            st.lists(inner, min_size=2, max_size=3).map(lambda p: "(" + "|".join(p) + ")"),
            inner.map(lambda p: f"(?:{p})?"), st.tuples(st.text(LETTERS.replace("é", ""), min_size=1, max_size=2), st.integers(1, 6)).map(lambda p: f"({p[0]}){{{p[1]}}}")),
        max_leaves=6)


@given(parts(), st.text("abABx é\n", max_size=14), st.booleans())
@settings(max_examples=1500, deadline=None)
def test_no_match_is_refused(pattern, text, any_case):
    """Whatever Python's regexes find satisfies the formula."""
    try:
        formula = required_grams(compile_find(pattern, "i" if any_case else ""))
    except ValueError:
        return
    found = re.search(pattern, text, re.IGNORECASE if any_case else 0)
    if found:
        assert holds(formula, grams(text))


PATTERNS = [
    ("license", ""), ("licen[cs]e", ""), ("LICENSE", "i"), ("licen[cs]e", "i"), ("(GNU|Apache|MIT) [Ll]icense", ""), ("version [0-9]", ""),
    ("[Vv]ersion [0-9]\\.[0-9]", ""), ("[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}", ""), ("@[a-z0-9]+\\.example", ""), ("GNU.*Public", ""),
    ("GNU.*version", "s"), ("^The ", "m"), ("\\.$", "m"), ("foundation", "i"), ("qqqqq", ""), ("the", ""), ("and|the", ""), ("free software", ""),
    ("(free|open) (software|source)", "i"), ("either version [0-9]", ""), ("warrant(y|ies)", ""), ("(copy|distribute)+", ""), ("ein(e|er|en)? ", ""),
    ("über|für", ""), ("ÜBER", "i"), ("ée", ""), ("\\bthe\\b", ""), ("[A-Z]{3,} ", ""), ("(?:soft|hard)ware", ""), ("s.ftware", ""), ("", ""), ("(?i)license", ""),
]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    docs = prose(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    path = str(tmp_path_factory.mktemp("trigrams"))
    return docs, TrigramIndex.ensure(docs, path), path


@pytest.mark.parametrize("pattern,options", PATTERNS)
def test_hits_of_a_scan(indexed, pattern, options):
    docs, index, _ = indexed
    expected = {r.doc_id for r in hits(docs, find("content", pattern, options)).select("doc_id").collect()}
    assert {r.doc_id for r in index.find(docs, pattern, options).select("doc_id").collect()} == expected


@pytest.mark.parametrize("pattern,on", [("(.*)license(.*)", "value"), ("(.*)licen[cs]e(.*)", "lower"), ("The (.*)license(.*)", "value"), ("(.*)x", "lower"), ("(.*)Free(.*)Foundation(.*)", "value")])
def test_whole_value_hits(indexed, pattern, on):
    docs, index, _ = indexed
    expected = {r.doc_id for r in hits(docs, regex("content", pattern, on)).select("doc_id").collect()}
    assert {r.doc_id for r in index.regex(docs, pattern, on).select("doc_id").collect()} == expected


def test_selective_patterns_read_few_documents(indexed):
    docs, index, path = indexed
    formula, most = index.plan(compile_find("GNU General Public"))
    assert formula != TRUE and most < 0.1 * index.documents and index.candidates(compile_find("GNU General Public")).count() <= most
    assert len(grams_in(formula)) <= trigrams.ASKED
    assert index.candidates(compile_find("the")) is None and index.candidates(compile_find("[a-z]+")) is None
    before = index.postings.inputFiles()
    assert TrigramIndex.ensure(docs, path).postings.inputFiles() == before, "made once"


def test_edges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trigrams, "PIECE", 7)
    monkeypatch.setattr(trigrams, "MOST_SHARE", 1.0)
    rng = random.Random(4)
    texts = [None, "", "ab", "abc", "ABC", "xxabcxx", "über abc", "a\nb\nc", "abc" * 50, "\U0001f600abc\U0001f600", "İabc", "ΑΣabcΣ"]
    texts += ["".join(rng.choice("abc \n") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, content string, gram string")
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    index = TrigramIndex.ensure(docs, f"{tmp_path}/index")
    for pattern, options in [("abc", ""), ("ABC", "i"), ("cab.a", ""), ("a b|c a b", ""), ("(ab|ca)c", ""), ("zzz", ""), ("abcabcabcabc", ""), ("b\nc", "")]:
        expected = {r.doc_id for r in hits(docs, find("content", pattern, options)).collect()}
        assert {r.doc_id for r in index.find(docs, pattern, options).collect()} == expected, pattern
    empty = docs.filter("false")
    assert TrigramIndex.ensure(empty, f"{tmp_path}/empty").find(empty, "abc").collect() == []
    with pytest.raises(ValueError):
        index.regex(docs, "(.*)abc(.*)", on="tokens")
