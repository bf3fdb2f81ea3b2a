import pytest
from pyspark.sql import functions as F

from logsieve.functions.extract import (count_matches, find_records, line_view, matching_lines,
                                        preview, split_lines)
from logsieve.functions.text import has_words, tokens
from logsieve.operators.clauses import compound, exists, find, find_not, regex, text, wildcard

ROWS = {
    "null": None,
    "empty": "",
    "two lines": "a\nERROR x",
    "cr": "a\rERROR",
    "ls": "a ERROR",
    "twice": "ERROR ERROR",
    "lower": "error",
    "plural": "ERRORS",
    "mail": "Jane@Test.org é \U0001F600 bob@example.com",
    "long": "word " * 20_000 + "ERROR",
    "joined": "pre_error error2 érror",
}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(ROWS.items()), "doc_id string, content string").cache()


def hits(rows, clause):
    return {r["doc_id"] for r in rows.filter(clause.holds).select("doc_id").collect()}


def test_negation_and_missing_values(rows):
    with_error = hits(rows, find("content", "ERROR"))
    assert with_error == {"two lines", "cr", "ls", "twice", "plural", "long"}
    assert hits(rows, find_not("content", "ERROR")) == set(ROWS) - with_error
    both = compound(filter=[wildcard("content", "*")], must_not=[regex("content", "(.*)ERROR(.*)")])
    assert hits(rows, both) == set(ROWS) - with_error - {"null"}
    assert hits(rows, exists("content")) == set(ROWS) - {"null"}
    assert hits(rows, compound(must_not=[find("content", "ERROR")])) == set(ROWS) - with_error


def test_dot_and_line_ends(rows):
    assert "two lines" not in hits(rows, find("content", "a.*ERROR"))
    assert "two lines" in hits(rows, find("content", "a.*ERROR", "s"))
    assert "two lines" in hits(rows, regex("content", "a.*ERROR.*"))
    assert hits(rows, find("content", "a.ERROR")) == {"cr", "ls"}


def test_words_are_whole_and_fold_case(rows):
    assert hits(rows, text("content", "ERROR")) == {"two lines", "cr", "ls", "twice", "lower", "long"}
    assert hits(rows, text("content", "errors nothing")) == {"plural"}
    assert hits(rows, text("content", "error x", mode="all")) == {"two lines"}


@pytest.mark.parametrize("query, mode", [("error", "any"), ("errors word", "any"), ("error word", "all"),
                                         ("érror", "any"), ("pre_error", "any"), ("example bob", "all")])
def test_word_tests_equal_token_arrays(rows, query, mode):
    wanted = F.array(*[F.lit(t) for t in query.split()])
    held = tokens(F.col("content"))
    expected = F.arrays_overlap(held, wanted) if mode == "any" else F.size(F.array_except(wanted, held)) == 0
    found = rows.filter(has_words(F.col("content"), query, mode)).select("doc_id").collect()
    assert {r[0] for r in found} == {r[0] for r in rows.filter(expected).select("doc_id").collect()}


def test_a_text_query_needs_a_word(rows):
    with pytest.raises(ValueError):
        text("content", "...")


def test_counts_and_lines(rows):
    out = {r["doc_id"]: r for r in rows.select(
        "doc_id", count_matches(F.col("content"), "ERROR").alias("n"),
        count_matches(F.col("content"), "[E]RROR").alias("m"),
        matching_lines(F.col("content"), "ERROR").alias("lines"),
        F.size(split_lines(F.col("content"))).alias("parts")).collect()}
    assert (out["twice"]["n"], out["twice"]["m"], out["twice"]["lines"]) == (2, 2, ["ERROR ERROR"])
    assert out["two lines"]["lines"] == ["ERROR x"]
    assert (out["empty"]["n"], out["empty"]["lines"], out["empty"]["parts"]) == (0, [], 1)
    assert out["null"]["n"] is None
    view = {(r["doc_id"], r["line_no"]) for r in line_view(rows, "ERROR").collect()}
    assert ("two lines", 2) in view and ("two lines", 1) not in view


def test_records_count_code_points(rows):
    mails = {r["doc_id"]: r["m"] for r in rows.select(
        "doc_id", find_records(F.col("content"), r"[A-Za-z]+@([A-Za-z]+)\.(com|org)").alias("m")).collect()}
    found = [(m["match"], m["idx"], m["captures"]) for m in mails["mail"]]
    assert found == [("Jane@Test.org", 0, ["Test", "org"]),
                     ("bob@example.com", ROWS["mail"].index("bob"), ["example", "com"])]
    assert mails["empty"] == []


def test_records_of_many_matches(rows):
    got = rows.filter("doc_id = 'long'").select(find_records(F.col("content"), "[a-z]+").alias("m")).first()["m"]
    assert len(got) == 20_000
    assert all(m["idx"] == 5 * n and m["match"] == "word" for n, m in enumerate(got))


def test_a_group_that_took_no_part_is_null(spark):
    row = spark.createDataFrame([("ab a",)], "t string").select(find_records(F.col("t"), "a(b)?").alias("m"))
    assert [m["captures"] for m in row.first()["m"]] == [["b"], [None]]
    with pytest.raises(ValueError):
        find_records(F.col("t"), "a*")


def test_preview(spark):
    rows = spark.createDataFrame([("x" * 100,), ("y" * 101,), (None,)], "t string")
    shown = [r[0] for r in rows.select(preview(F.col("t"))).collect()]
    assert shown == ["x" * 100, "y" * 100 + "...", None]


def test_long_texts_do_not_overflow(spark):
    big = spark.range(1).select(F.concat(F.repeat(F.lit("abcd\n"), 100_000), F.lit("z")).alias("content"))
    stored = big.checkpoint() if spark.sparkContext.getCheckpointDir() else big.cache()
    for clause in (find("content", "(?:a|b|c|d|[^a])*z"), find("content", "(abcd\n)+z"), regex("content", "(.*)a(.*)z(.*)")):
        assert stored.filter(clause.holds).count() == 1


def test_scores(rows):
    clause = compound(must=[find("content", "ERROR")], should=[text("content", "x"), find("content", "ERROR ERROR")])
    scored = {r["doc_id"]: r["score"] for r in rows.filter(clause.holds).select("doc_id", clause.score.alias("score")).collect()}
    assert (scored["two lines"], scored["twice"], scored["cr"]) == (2.0, 2.0, 1.0)
    two = compound(should=[find("content", "ERROR"), text("content", "error"), find("content", "x")], minimum_should=2)
    assert hits(rows, two) == {"two lines", "cr", "ls", "twice", "long"}
    with pytest.raises(ValueError):
        compound()
