import random
import re

import pytest

from logsieve.functions.patterns import FIND, WHOLE, compile_pattern
from logsieve.functions.text import query_terms
from logsieve.operators.clauses import wildcard


def java(source, dialect, options=""):
    return compile_pattern(source, dialect, options).java


@pytest.mark.parametrize("source, expected", [
    ("(.*)ERROR [0-9]{4}(.*)", "(?s)ERROR [0-9]{4}"),
    (".*WARN.*", "(?s)WARN"),
    ("2024-0[1-9]-.*", r"(?s)\A2024\-0[1-9]\-"),
    ("AUDIT-EVENT(.*)op=DELETE(.*)", r"(?s)\AAUDIT\-EVENT(.*)op\=DELETE"),
    ("(.*)end", r"(?s)end\z"),
    ("a|b", r"(?s)\A(?:a|b)\z"),
    (r'(.*)(\"port\":[ ]*5432)(.*)', r'(?s)(\"port\"\:[ ]*5432)'),
    ('(.*)"a.b"(.*)', r"(?s)(?:a\.b)"),
    ('"ab"*', r"(?s)\A(?:ab)*\z"),
    (r"(.*)[a-z]+@[a-z]+\.(com|org)(.*)", r"(?s)[a-z]+\@[a-z]+\.(com|org)"),
    (".*", "(?s)"),
    ("^a$", r"(?s)\A\^a\$\z"),
])
def test_whole_value_patterns(source, expected):
    assert java(source, WHOLE) == expected


@pytest.mark.parametrize("source", [
    r"\s+", r"\d", r"\w", "(?i)error", "(?:a)", 'open"quote', "a~b", "a&b", "<1-9>", "#", "a*?", "(a", "a)", "[a", "*a",
])
def test_whole_value_refusals(source):
    with pytest.raises(ValueError):
        compile_pattern(source, WHOLE)


@pytest.mark.parametrize("source, options, expected", [
    ("ERROR", "", "(?d)ERROR"),
    ("a.*b", "", "(?d)a.*b"),
    ("error", "i", "(?di)error"),
    ("é", "i", "(?diu)é"),
    (r"\d+\s", "", r"(?d)\d+\s"),
    ("a+?", "s", "(?ds)a+?"),
    ("x{2,}", "", "(?d)x{2,}"),
    (r"\p{Lu}x", "", r"(?d)\p{Lu}x"),
    ("(?:a|b|[0-9])*z", "", "(?d)[ab[0-9]]*z"),
    ("(a|b)+", "", "(?d)([ab])+"),
    ("(?:ab)*", "", "(?d)(?:ab)*"),
    ("(a+b)*", "", "(?d)(a+b)*+"),
    ("(ab|a)+", "", "(?d)(ab|a)++"),
    ("([a-z]+ )+X", "", "(?d)([a-z]+ )++X"),
    ("([a-z]+,)*[0-9]", "i", "(?di)([a-z]+\\,)*+[0-9]"),
    ("((ab|c){1,20}d){1,20}$", "", "(?d)((ab|c){1,20}d){1,20}$"),
    (r"(?i)error(?=:)", "", r"(?d)(?i)error(?=:)"),
    (r"(?<w>[a-z]+) \k<w>", "", r"(?d)(?<w>[a-z]+) \k<w>"),
    ("a b  # c", "x", "(?dx)a b  # c"),
])
def test_find_patterns(source, options, expected):
    assert java(source, FIND, options) == expected


@pytest.mark.parametrize("source", [
    "(?=a", r"(a)\2", "(?<n>a)(?<n>b)", "(a+b)*a", "(ab|a)+b", "(a?)*", "(a+)*b", "((ab|c){1,500}d){1,500}$", "a**", "a++", "[[:alpha:]]", "a{2,1}", r"\q", "x{",
])
def test_find_refusals(source):
    with pytest.raises(ValueError):
        compile_pattern(source, FIND)


def test_unknown_options_and_dialects():
    with pytest.raises(ValueError):
        compile_pattern("a", FIND, "q")
    with pytest.raises(ValueError):
        compile_pattern("a", "glob")
    with pytest.raises(ValueError):
        compile_pattern("a", WHOLE, "i")


@pytest.mark.parametrize("source, dialect, literals, needs", [
    ("ERROR", FIND, ("ERROR",), ("ERROR",)),
    ("(Exception|Error|WARN)", FIND, ("Exception", "Error", "WARN"), ("Exception", "Error", "WARN")),
    ("CRIT-[0-9]{4}.*host=prod-db-01", FIND, None, ("host=prod-db-01",)),
    ("(ab)?cde+f", FIND, None, ()),
    ("(abcd)+x", FIND, None, ("abcd",)),
    ("(abc|d)e", FIND, None, ()),
    ("a.c", FIND, None, ()),
])
def test_literals(source, dialect, literals, needs):
    pattern = compile_pattern(source, dialect)
    assert (pattern.literals, pattern.needs) == (literals, needs)


def test_widths_and_groups():
    pattern = compile_pattern(r"([a-z]+)@(x|)(.(yz)?)")
    assert pattern.least_width == 3
    assert pattern.groups == (1, 0, 1, 2)


def test_find_patterns_agree_with_python_on_plain_text(spark):
    from pyspark.sql import functions as F
    texts = ["", "ERROR", "a\nERROR x", "a.b", "port: 5432", "x" * 50 + "WARN 2024-01-01", "Café 10.0.0.1"]
    sources = ["ERROR", "a.*ERROR", r"a\.b", "[0-9]{4}", "(ERROR|WARN)", r"\d+\.\d+", "^ERROR", r"\bWARN\b", "x{3,5}"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", *[compile_pattern(s).test(F.col("t")).alias(str(i)) for i, s in enumerate(sources)]).collect()
    for row in found:
        assert [row[str(i)] for i in range(len(sources))] == [bool(re.search(s, row["t"])) for s in sources]


def test_query_terms():
    assert query_terms("DEPLOY production, deploy; x_1 Élan") == ["deploy", "production", "x_1", "élan"]
    with pytest.raises(ValueError):
        query_terms(" ... ")


def test_wildcards(spark):
    rows = spark.createDataFrame([("a_b",), ("axb",), ("a%b",), (None,), ("",)], "t string")
    def hit(query):
        return {r["t"] for r in rows.filter(wildcard("t", query).holds).collect()}
    assert hit("*") == {"a_b", "axb", "a%b", ""}
    assert hit("a?b") == {"a_b", "axb", "a%b"}
    assert hit("a_b") == {"a_b"}
    assert hit(r"a\*b") == set()
    assert hit("*%*") == {"a%b"}


def random_pattern(rng, depth=2):
    def atom():
        kind = rng.randrange(7 if depth else 5)
        if kind < 3:
            return rng.choice("abc") * (1 if kind else rng.randint(1, 3))
        if kind == 3:
            return "."
        if kind == 4:
            return rng.choice(["[ab]", "[^a]", "[b-c]"])
        inner = "|".join(random_pattern(rng, depth - 1) for _ in range(rng.randint(1, 3)))
        return f"({inner})"

    def part():
        text = atom()
        mark = rng.choice(["", "", "", "?", "*", "+", "{2}", "{1,2}"])
        return text + (mark if len(text) == 1 or not text.startswith("(") else rng.choice(["", "?", "{2}", "*", "+"]))
    return "".join(part() for _ in range(rng.randint(1, 4)))


def accepted(source, dialect):
    try:
        return bool(compile_pattern(source, dialect))
    except ValueError:
        return False


@pytest.mark.parametrize("source, options, hits", [
    (r"(?<![a-z])error(?!s)", "", ["an error"]), (r"([a-z])\1 (?<w>[a-z]+) \k<w>", "", ["aa bc bc"]), ("(?i)ERROR", "", ["an error", "errors"]),
    (r"an\ error  # a comment", "x", ["an error"]), ("((a|bc)+,)+;", "", ["x" + "abca," * 200_000 + ";"]),
    ("([a-z]+ )+X", "", ["word " * 200_000 + "X"]),
])
def test_constructs_of_the_find_dialect(spark, source, options, hits):
    from pyspark.sql import functions as F
    texts = ["an error", "errors", "aa bc bc", "x" + "abca," * 200_000 + ";", "word " * 200_000 + "X", "abc, d"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert sorted(r["t"] for r in rows.filter(compile_pattern(source, FIND, options).test(F.col("t"))).collect()) == sorted(hits)


@pytest.mark.parametrize("dialect", [FIND, WHOLE])
def test_random_patterns_agree_with_python(spark, monkeypatch, dialect):
    """Literal tests and pre-filters must not change the result; short literals are used here too."""
    from pyspark.sql import functions as F
    monkeypatch.setattr("logsieve.functions.patterns.MIN_LITERAL", 1)
    rng = random.Random(7)
    texts = ["".join(rng.choice("abc\n") for _ in range(rng.randint(0, 7))) for _ in range(150)]
    sources = [random_pattern(rng) for _ in range(240)]
    if dialect == WHOLE:
        sources = [rng.choice(["", "(.*)", ".*"]) + s + rng.choice(["", "(.*)", ".*"]) for s in sources]
    sources = [s for s in sources if accepted(s, dialect)]
    assert len(sources) > 120 and sum("++" in java(s, dialect) or "*+" in java(s, dialect) for s in sources) > 10
    rows = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).cache()
    for start in range(0, len(sources), 20):
        some = sources[start:start + 20]
        found = rows.select("t", *[compile_pattern(s, dialect).test(F.col("t")).alias(f"p{i}")
                                   for i, s in enumerate(some)]).collect()
        for i, source in enumerate(some):
            expected = [bool(re.search(source, t) if dialect == FIND else re.fullmatch(source, t, re.DOTALL)) for t in texts]
            assert [r[f"p{i}"] for r in found] == expected, source
