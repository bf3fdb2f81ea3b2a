"""The query catalogue: ten examples and the load-test patterns.

All run on any DataFrame with ``doc_id``, ``filename``, ``content`` and ``metadata``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.functions.extract import count_matches, find_records, matching_lines
from logsieve.operators.clauses import Clause, compound, find, find_not, regex, text, wildcard
from logsieve.operators.facets import facet
from logsieve.operators.parity import parity
from logsieve.operators.relevance import corpus_stats
from logsieve.operators.search import capped, search
from logsieve.operators.textindex import TokenIndex

# The patterns and words of the examples.
ERROR_DATE = "(.*)ERROR [0-9]{4}-[0-9]{2}-[0-9]{2}(.*)"
EMAIL_LOWER = r"(.*)[a-z]+@[a-z]+\.(com|org)(.*)"
EMAIL = r"[A-Za-z]+@[A-Za-z]+\.(com|org)"
PORT = r'(.*)(\"port\":[ ]*5432)(.*)'
TROUBLE = "(.*)(Exception|Error|WARN)(.*)"
ERROR = "(.*)ERROR(.*)"
IP = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
WARN_DATE = "(.*)WARN [0-9]{4}-[0-9]{2}-[0-9]{2}(.*)"

SHOWN = ("doc_id", "filename", "content", "metadata")


def error_dates(docs: DataFrame, limit: int = 0) -> DataFrame:
    """1: error lines with a date; a filter, not scored."""
    return search(docs, compound(filter=[regex("content", ERROR_DATE)]), SHOWN, limit)


def emails(docs: DataFrame, limit: int = 0, pattern: str = EMAIL_LOWER, extracted: str = EMAIL) -> DataFrame:
    """2: e-mail addresses in any case, extracted with their places."""
    found = find_records(F.col("content"), extracted, "i").alias("matched_emails")
    return search(docs, regex("content", pattern, on="lower"), (*SHOWN, found), limit, score=True)


def json_field(docs: DataFrame, limit: int = 0, pattern: str = PORT) -> DataFrame:
    """3: a field of a JSON body, matched as text."""
    return search(docs, regex("content", pattern), SHOWN, limit, score=True)


def trouble(docs: DataFrame, limit: int = 0) -> DataFrame:
    """4: one pattern with alternatives."""
    return search(docs, regex("content", TROUBLE), SHOWN, limit, score=True)


def error_lines(docs: DataFrame, limit: int = 0) -> DataFrame:
    """5: the matching lines and the number of matches."""
    columns = ("doc_id", "filename", "metadata",
               matching_lines(F.col("content"), "ERROR").alias("error_lines"),
               count_matches(F.col("content"), "ERROR").alias("error_count"))
    return search(docs, regex("content", ERROR), columns, limit, score=True)


def addresses(docs: DataFrame, limit: int = 0) -> DataFrame:
    """6: IPv4-shaped texts, extracted with their places."""
    found = find_records(F.col("content"), IP).alias("ip_addresses")
    return search(docs, regex("content", f"(.*){IP}(.*)"), (*SHOWN, found), limit, score=True)


def without_error(docs: DataFrame, limit: int = 0) -> DataFrame:
    """7: documents that have content but not the pattern."""
    clause = compound(filter=[wildcard("content", "*")], must_not=[regex("content", ERROR)])
    return search(docs, clause, SHOWN, limit, score=True)


def text_hits(docs: DataFrame, limit: int = 0, index: TokenIndex | None = None) -> DataFrame:
    """8, first list: the keyword as a word, scored by relevance.

    With an index neither statistics nor scores need the texts; without one, the documents are read for both.
    """
    shown = ("doc_id", "filename", "metadata")
    if index is None:
        word = text("content", "ERROR", stats=corpus_stats(docs, "ERROR"))
        return search(docs, word, shown, limit, score=True)
    return capped(docs.select(*shown).join(index.rank("ERROR", limit), "doc_id"), limit)


def regex_hits(docs: DataFrame, limit: int = 0) -> DataFrame:
    """8, second list: the keyword as a pattern."""
    return search(docs, regex("content", ERROR), ("doc_id", "filename", "metadata"), limit, score=True)


def text_against_regex(docs: DataFrame) -> DataFrame:
    """8: the same keyword as a word and as a pattern, and where they differ."""
    return parity(docs, regex("content", ERROR), {"text": text("content", "ERROR")})


def trouble_by_type(docs: DataFrame, path: str = "metadata.type") -> DataFrame:
    """9: matches per document type, with the total."""
    return facet(docs, regex("content", TROUBLE), path)


def warn_dates(docs: DataFrame, limit: int = 0, index: TokenIndex | None = None) -> DataFrame:
    """10: a word first, then a pattern on what is left; with an index, on the documents that it finds."""
    if index is not None:
        return search(index.matching(docs, "WARN"), regex("content", WARN_DATE), SHOWN, limit, score=True)
    clause = compound(filter=[text("content", "WARN")], must=[regex("content", WARN_DATE)])
    return search(docs, clause, SHOWN, limit, score=True)


# The default number of rows a limited query returns.
EXAMPLE_LIMIT = 10
SCENARIO_LIMIT = 20


# The load-test patterns, for log documents. Those of records that no given table holds are
# replaced by patterns of the same kind: a code, an operation, a rare word.
LOAD_FIND = (("date_prefix", "2024-0[1-9]-"), ("user_code", "user [0-9]{2} "), ("log_level_warn", "WARN"),
             ("multi_level", "(ERROR|WARN)"), ("error_code", '"k": 1[0-9]'), ("operation", "ERROR.*69"))
LOAD_FIND_NOT = (("not_error", "ERROR"),)
LOAD_WHOLE = (("date_prefix", ".*2024-0[1-9]-.*"), ("info_first", "INFO .*"), ("log_level_warn", ".*WARN.*"))
LOAD_COMPOUND = (("error_compound", "ERROR [0-9]{4}.*", "ERROR"), ("warn_compound", ".*WARN.*", "WARN"),
                 ("info_compound", ".*INFO.*", "INFO"))
LOAD_TEXT = (("text_error", "ERROR"), ("text_warn", "WARN"), ("text_info", "INFO"))
LOAD_WHOLE_NOT = (("not_error", ".*ERROR.*"),)


def load_clauses() -> dict[str, Clause]:
    """Every load-test query by ``kind/label``."""
    found = {f"regex/{label}": find("content", p) for label, p in LOAD_FIND}
    found |= {f"regex_not/{label}": find_not("content", p) for label, p in LOAD_FIND_NOT}
    found |= {f"search_regex/{label}": regex("content", p) for label, p in LOAD_WHOLE}
    found |= {f"compound/{label}": compound(filter=[text("content", words)], must=[regex("content", p)])
              for label, p, words in LOAD_COMPOUND}
    found |= {f"text/{label}": text("content", words) for label, words in LOAD_TEXT}
    found |= {f"search_must_not/{label}": compound(filter=[wildcard("content")], must_not=[regex("content", p)])
              for label, p in LOAD_WHOLE_NOT}
    return found


def hit_counts(docs: DataFrame, clauses: dict[str, Clause]) -> DataFrame:
    """Rows ``(name, hits)`` for many queries from one scan; only counts are shuffled."""
    counted = docs.agg(*[F.count_if(c.is_hit).alias(f"n{i}") for i, c in enumerate(clauses.values())])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(f"n{i}").alias("hits"))
        for i, name in enumerate(clauses)])))
