"""Trigrams are cut a batch at a time, without a pattern tried at each character."""

from logsieve.operators import trigrams
from logsieve.operators.trigrams import trigram_table


def test_trigrams_are_those_of_the_texts(spark):
    texts = ["", "ab", "abc", "ABCabc", "aé bcd", "日本abc日d e", "a\n\x00\x7fb", "x" * 60_000 + "yz"]
    docs = spark.createDataFrame([*enumerate(texts), (99, None), (None, "xyz")], "doc_id long, content string")
    table = trigram_table(docs)
    assert trigrams.ROWS_PER_FILE <= 2_000_000
    assert "regexp_extract_all" not in table._jdf.queryExecution().executedPlan().toString()
    expected = set()
    for key, text in [*enumerate(texts), (None, "xyz")]:
        text = text.lower()
        expected |= {(text[i:i + 3], key) for i in range(len(text) - 2) if text[i:i + 3].isascii()}
    rows = [tuple(r) for r in table.collect()]
    # A text of two pieces has a trigram once for each.
    assert set(rows) == expected and len(rows) == len(expected) + 1
