"""One query per operator, on whole test tables, named by operator id."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.functions import vectors
from logsieve.functions.extract import (count_matches, find_all, find_records, line_view,
                                        matching_lines, or_missing, preview, split_lines)
from logsieve.functions.patterns import compile_pattern
from logsieve.functions.text import tokens
from logsieve.operators import report
from logsieve.operators.bitmaps import BitmapIndex, Words
from logsieve.operators.blockmax import BlockIndex
from logsieve.operators.clauses import (Clause, clause, compound, contains, exists, find, find_not,
                                        regex, text, wildcard)
from logsieve.operators.facets import facet
from logsieve.operators.nearest import nearest, nearest_batch
from logsieve.operators.parity import compare_keys, difference, parity
from logsieve.operators.positions import PositionIndex
from logsieve.operators.search import (count_hits, first, hits, resolve_limit, search, top)
from logsieve.operators.segments import SegmentedIndex
from logsieve.operators.sketches import RANK_ERROR, Sketches
from logsieve.operators.terms import TermDictionary
from logsieve.operators.textindex import TokenIndex, token_table
from logsieve.operators.trigrams import TrigramIndex
from logsieve.operators.vectorindex import VectorIndex
from logsieve.plans import catalogue
from logsieve.plans.registry import LOGS, PROSE, RATED, WORDS, Tables, query, tokens_sql
from logsieve.sources import tables
from logsieve.sources.documents import with_lower
from logsieve.sources.logs import matching_log_lines

LICENSE = "licen[cs]e"
IP = catalogue.IP
MAIL = r"[a-z0-9.]+@[a-z0-9]+\.example\.com"
KEY69 = '"k":[ ]*69'


def joined(values: Column, mark: str = "|") -> Column:
    return F.array_join(values, mark)


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(name, digits).alias(name)


# ---------------------------------------------------------------- sources and sinks

@query("s02_log_documents", f"WITH {LOGS} SELECT doc_id, filename, content, type, server FROM logs")
def _(t: Tables):
    return t.assembled().select("doc_id", "filename", "content", "metadata.type", "metadata.server")


@query("s03_lower_copy", "SELECT doc_id, lower(text) AS content_lc FROM documents")
def _(t: Tables):
    return with_lower(t.prose()).select("doc_id", "content_lc")


@query("s04_batch_insert", """SELECT 'documents' AS part, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents
  UNION ALL SELECT 'conversations', count(*), sum(length(text))::BIGINT FROM conversations""")
def _(t: Tables):
    path = tables.scratch_path(t.spark, "s04")
    tables.rebuild(t.documents.select(F.lit("documents").alias("part"), "text"), path)
    tables.append(t.conversations.select(F.lit("conversations").alias("part"), "text"), path)
    return t.spark.read.parquet(path).groupBy("part").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("s05_rebuild", "SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang")
def _(t: Tables):
    path = tables.scratch_path(t.spark, "s05")
    tables.rebuild(t.documents, path)
    tables.rebuild(t.documents, path)
    return t.spark.read.parquet(path).groupBy("lang").agg(
        F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("s06_ensure_table", f"""WITH {PROSE} SELECT doc_id, filename, lower(content) AS content_lc FROM prose""")
def _(t: Tables):
    path = tables.library_path(t.spark, "s06")
    expected = tables.row_count(t.documents)
    for _ in range(2):  # the second call finds the table in place
        stored = tables.ensure_table(t.spark, path, lambda: with_lower(t.prose()), expected, ["content_lc"])
    return stored.select("doc_id", "filename", "content_lc")


@query("s07_full_scan", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(t: Tables):
    return t.documents


@query("s08_filtered_scan", "SELECT doc_id FROM documents WHERE regexp_matches(text, 'licen[cs]e')")
def _(t: Tables):
    return search(t.prose(), find("content", LICENSE), ("doc_id",))


@query("s09_field_probe", " UNION ALL ".join(
    f"SELECT '{c}' AS field, coalesce(bool_or({c} IS NOT NULL), false) AS present FROM rated"
    for c in ("doc_id", "content", "rating")).join([f"WITH {RATED} ", ""]))
def _(t: Tables):
    return tables.fields_present(t.rated().select("doc_id", "content", "rating"))


@query("s10_row_count", "SELECT count(*) AS n FROM documents")
def _(t: Tables):
    return t.documents.agg(F.count("*").alias("n"))


@query("s11_token_table", f"""WITH {PROSE}, words AS (SELECT doc_id, {tokens_sql()} AS w FROM prose),
  each AS (SELECT doc_id, len(w) AS dl, unnest(w) AS token FROM words)
  SELECT token, doc_id, count(*) AS tf, max(dl) AS dl FROM each GROUP BY token, doc_id""")
def _(t: Tables):
    return token_table(t.prose()).select(
        "token", "doc_id", F.col("tf").cast("long").alias("tf"), F.col("dl").cast("long").alias("dl"))


# ---------------------------------------------------------------- projections

@query("p01_inclusion", f"WITH {PROSE} SELECT doc_id, filename, content, type, server FROM prose "
       "WHERE regexp_matches(content, 'licen[cs]e')")
def _(t: Tables):
    return search(t.prose(), find("content", LICENSE), catalogue.SHOWN).select(
        "doc_id", "filename", "content", "metadata.type", "metadata.server")


@query("p02_key_only", f"WITH {LOGS} SELECT doc_id FROM logs WHERE contains(content, 'ERROR')")
def _(t: Tables):
    return search(t.logs(), find("content", "ERROR"))


@query("p03_computed_fields", f"""WITH {LOGS} SELECT doc_id, upper(type) AS kind, length(content) AS n_chars
  FROM logs WHERE contains(content, 'WARN')""")
def _(t: Tables):
    computed = (F.upper("metadata.type").alias("kind"), F.length("content").cast("long").alias("n_chars"))
    return search(t.logs(), find("content", "WARN"), ("doc_id", *computed))


@query("p04_nested_path", f"WITH {PROSE} SELECT doc_id, type, server FROM prose")
def _(t: Tables):
    return t.prose().select("doc_id", F.col("metadata.type").alias("type"), F.col("metadata.server").alias("server"))


@query("p05_score_column", f"""WITH {PROSE} SELECT doc_id, 1.0::DOUBLE AS score FROM prose
  WHERE regexp_matches(content, '{IP}')""")
def _(t: Tables):
    return search(t.prose(), regex("content", f"(.*){IP}(.*)"), score=True)


@query("p06_array_element_field", f"""WITH {PROSE} SELECT doc_id,
  array_to_string(regexp_extract_all(content, '{IP}'), '|') AS found FROM prose
  WHERE regexp_matches(content, '{IP}')""")
def _(t: Tables):
    records = search(t.prose(), find("content", IP), ("doc_id", find_records(F.col("content"), IP).alias("m")))
    return records.select("doc_id", joined(F.col("m.match")).alias("found"))


@query("p07_missing_default", """SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'N/A') AS quality
  FROM documents d LEFT JOIN labels l USING (doc_id)""")
def _(t: Tables):
    labelled = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return labelled.select("doc_id", or_missing(F.col("quality").cast("string")).alias("quality"))


@query("p08_preview", """SELECT doc_id, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END
  AS preview FROM documents""")
def _(t: Tables):
    return t.documents.select("doc_id", preview(F.col("text")).alias("preview"))


# ---------------------------------------------------------------- filters

def _keys(name: str, docs: str, sql_test: str, make) -> None:
    """A query that returns the keys of the documents a clause matches."""
    source = {"prose": PROSE, "logs": LOGS, "rated": RATED}[docs]

    @query(name, f"WITH {source} SELECT doc_id FROM {docs} WHERE {sql_test}")
    def _(t: Tables):
        return search(getattr(t, docs)(), make(), ("doc_id",))


DATE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_keys("f01_regex_whole_value", "logs", f"regexp_matches(content, 'ERROR {DATE}')",
      lambda: compound(filter=[regex("content", f"(.*)ERROR {DATE}(.*)")]))


@query("f02_regex_scoring", f"""WITH {PROSE} SELECT doc_id, 1.0::DOUBLE AS score FROM prose
  WHERE regexp_matches(content, 'licen[cs]e')""")
def _(t: Tables):
    return search(t.prose(), regex("content", f"(.*){LICENSE}(.*)"), score=True)


_keys("f03_regex_lower", "prose", "regexp_matches(lower(content), 'licen[cs]e')",
      lambda: regex("content", f"(.*){LICENSE}(.*)", on="lower"))
_keys("f04_find", "prose", "regexp_matches(content, 'licen[cs]e')", lambda: find("content", LICENSE))
_keys("f05_find_any_case", "prose", "regexp_matches(content, 'licen[cs]e', 'i')",
      lambda: find("content", LICENSE, "i"))
_keys("f06_alternation", "logs", "regexp_matches(content, '(Exception|Error|WARN)')",
      lambda: find("content", "(Exception|Error|WARN)"))
_keys("f07_json_field", "logs", f"regexp_matches(content, '{KEY69}')",
      lambda: regex("content", r'(.*)(\"k\":[ ]*69)(.*)'))
_keys("f08_ip_shape", "prose", f"regexp_matches(content, '{IP}')", lambda: find("content", IP))
_keys("f09_date", "logs", f"regexp_matches(content, '{DATE}')", lambda: find("content", DATE))
_keys("f10_email", "prose", f"regexp_matches(lower(content), '{MAIL}')",
      lambda: regex("content", f"(.*){MAIL}(.*)", on="lower"))
_keys("f11_ordered_same_line", "logs", "regexp_matches(content, 'ERROR.*69')", lambda: find("content", "ERROR.*69"))
_keys("f11_ordered_across_lines", "logs", "regexp_matches(content, 'ERROR.*WARN', 's')",
      lambda: regex("content", "(.*)ERROR(.*)WARN(.*)"))
_keys("f12_anchored_start", "prose", "regexp_matches(content, '^The .*license', 's')",
      lambda: regex("content", "The (.*)license(.*)"))
_keys("f12_anchored_prefix", "prose", r"regexp_matches(content, '^[A-Z][a-z]{1,3}\. ', 's')",
      lambda: regex("content", r"[A-Z][a-z]{1,3}\. .*"))
_keys("f12_anchored_literal", "logs", "starts_with(content, 'ERROR 2024-')",
      lambda: regex("content", "ERROR 2024-.*"))
_keys("f12_anchored_both_ends", "prose", r"regexp_full_match(content, 'The .*\.', 's')",
      lambda: regex("content", r"The .*\."))


@query("f12_anchored_pages", """SELECT page_id FROM pages WHERE starts_with(html, '<!DOCTYPE html><html lang="de"')""")
def _(t: Tables):
    return search(t.pages, regex("html", r'\<!DOCTYPE html\>\<html lang=\"de\".*'), ("page_id",))


# Documents without a label have no rating: negation and existence on values that are really missing.
_keys("f13_find_not", "prose", "NOT regexp_matches(content, 'licen[cs]e')", lambda: find_not("content", LICENSE))
_keys("f13_find_not_missing", "rated", "NOT coalesce(regexp_matches(rating, '1'), false)", lambda: find_not("rating", "1"))
_keys("f14_must_not", "rated", "rating IS NOT NULL AND NOT regexp_matches(content, 'licen[cs]e')",
      lambda: compound(filter=[wildcard("rating", "*")], must_not=[regex("content", f"(.*){LICENSE}(.*)")]))
_keys("f15_wildcard_all", "rated", "rating IS NOT NULL", lambda: wildcard("rating", "*"))
_keys("f15_wildcard_pattern", "prose", "content LIKE '%licen_e%'", lambda: wildcard("content", "*licen?e*"))
_keys("f16_text_one_term", "prose", f"list_contains({tokens_sql()}, 'license')", lambda: text("content", "LICENSE"))
_keys("f17_text_any_term", "prose", f"list_has_any({tokens_sql()}, ['license', 'gnu'])",
      lambda: text("content", "License GNU"))
_keys("f17_text_all_terms", "prose", f"list_has_all({tokens_sql()}, ['license', 'gnu'])",
      lambda: text("content", "License GNU", mode="all"))
_keys("f18_compound_text_regex", "prose",
      f"list_has_any({tokens_sql()}, ['license', 'gnu']) AND regexp_matches(content, '[Vv]ersion [0-9]')",
      lambda: compound(filter=[text("content", "license gnu")], must=[regex("content", "(.*)[Vv]ersion [0-9](.*)")]))
_keys("f19_contains", "prose", "content LIKE '%license%'", lambda: contains("content", "license"))


# ---------------------------------------------------------------- clauses

def _scored(name: str, sql_test: str, sql_score: str, make) -> None:
    @query(name, f"WITH {PROSE} SELECT doc_id, ({sql_score})::DOUBLE AS score FROM prose WHERE {sql_test}")
    def _(t: Tables):
        return search(t.prose(), make(), score=True)


HAS_LICENSE = f"list_contains({tokens_sql()}, 'license')"
HAS_IP = f"regexp_matches(content, '{IP}')"
_scored("c01_filter", HAS_LICENSE, "0.0", lambda: compound(filter=[text("content", "license")]))
_scored("c02_must", HAS_LICENSE, "1.0", lambda: compound(must=[text("content", "license")]))
_scored("c03_must_not", f"{HAS_LICENSE} AND NOT contains(content, 'GNU')", "1.0",
        lambda: compound(must=[text("content", "license")], must_not=[find("content", "GNU")]))
_scored("c04_should", f"{HAS_LICENSE} OR {HAS_IP}",
        f"CASE WHEN {HAS_LICENSE} THEN 1.0 ELSE 0.0 END + CASE WHEN {HAS_IP} THEN 1.0 ELSE 0.0 END",
        lambda: compound(should=[text("content", "license"), find("content", IP)]))
_scored("c04_optional_should", HAS_IP, f"1.0 + CASE WHEN {HAS_LICENSE} THEN 1.0 ELSE 0.0 END",
        lambda: compound(must=[find("content", IP)], should=[text("content", "license")]))
_keys("c05_path_value", "prose", "regexp_matches(content, 'License')",
      lambda: clause("content", "(.*)License(.*)", "regex", on="value"))
_keys("c05_path_lower", "prose", "regexp_matches(lower(content), 'license')",
      lambda: clause("content", "(.*)license(.*)", "regex", on="lower"))
_keys("c05_path_tokens", "prose", HAS_LICENSE, lambda: clause("content", "License", "text", on="tokens"))
_keys("c06_exists", "rated", "rating IS NOT NULL", lambda: exists("rating"))


def bm25_sql(docs: str, terms: list[str]) -> str:
    """CTEs ending in ``scored(doc_id, score)`` for the documents with any of the terms."""
    tf = ", ".join(f"len(list_filter(w, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(terms))
    df = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(terms)))
    damping = "(1.2 * (0.25 + 0.75 * dl / (total / n)))"
    score = " + ".join(f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} / (tf{i} + {damping})"
                       for i in range(len(terms)))
    held = " OR ".join(f"tf{i} > 0" for i in range(len(terms)))
    return f"""words AS (SELECT doc_id, {tokens_sql()} AS w FROM {docs} WHERE content IS NOT NULL),
counted AS (SELECT doc_id, len(w)::DOUBLE AS dl, {tf} FROM words),
stats AS (SELECT count(*)::DOUBLE AS n, sum(dl)::DOUBLE AS total, {df} FROM counted),
scored AS (SELECT doc_id, {score} AS score FROM counted, stats WHERE {held})"""


@query("c07_score_of_hit", f"""WITH {PROSE}, {bm25_sql('prose', ['license', 'gnu'])}
  SELECT s.doc_id, round(s.score + 1.0, 6) AS score FROM scored s JOIN prose p USING (doc_id)
  WHERE contains(p.content, 'ersion')""")
def _(t: Tables):
    docs = t.prose()
    words = text("content", "license gnu", stats=_stored_index(t).stats("license gnu"))
    both = compound(must=[words, find("content", "ersion")])
    return search(docs, both, score=True).select("doc_id", rounded("score"))


# ---------------------------------------------------------------- joins

def _stored_index(t: Tables) -> TokenIndex:
    """The token table of the documents, stored in the shared folder and made anew when they change."""
    key = hashlib.sha256(t.folder.encode()).hexdigest()
    return TokenIndex.ensure(t.prose(), tables.library_path(t.spark, f"index-{key}"))


def _log_index(t: Tables) -> TokenIndex:
    key = hashlib.sha256(t.folder.encode()).hexdigest()
    return TokenIndex.ensure(t.logs(), tables.library_path(t.spark, f"log-index-{key}"))


@query("j01_index_semi_join", f"""WITH {PROSE} SELECT doc_id, filename FROM prose
  WHERE list_has_any({tokens_sql()}, ['license', 'gnu'])""")
def _(t: Tables):
    return _stored_index(t).matching(t.prose(), "license gnu").select("doc_id", "filename")


@query("j01_index_semi_join_all", f"""WITH {PROSE} SELECT doc_id, filename FROM prose
  WHERE list_has_all({tokens_sql()}, ['license', 'gnu'])""")
def _(t: Tables):
    return _stored_index(t).matching(t.prose(), "license gnu", mode="all").select("doc_id", "filename")


@query("j01_index_then_regex", f"""WITH {PROSE} SELECT doc_id FROM prose
  WHERE list_has_any({tokens_sql()}, ['license', 'gnu']) AND regexp_matches(content, '[Vv]ersion [0-9]')""")
def _(t: Tables):
    survivors = _stored_index(t).matching(t.prose(), "license gnu")
    return search(survivors, regex("content", "(.*)[Vv]ersion [0-9](.*)"))


@query("j01_index_common_word", f"""WITH {PROSE} SELECT doc_id, filename FROM prose
  WHERE list_contains({tokens_sql()}, 'the')""")
def _(t: Tables):
    return _stored_index(t).matching(t.prose(), "the").select("doc_id", "filename")


# The collection of an index that follows its documents: three batches appended, those of poor quality changed, toxic ones deleted.
REVISED = """revised AS (SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) THEN 'revised ' || text ELSE text END AS content
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))"""


def _segments(t: Tables) -> SegmentedIndex:
    docs, labels = t.prose().select("doc_id", "content", "metadata.type"), t.labels
    state = f"revised: {tables.source_state(docs)}; {tables.source_state(labels)}"
    key = hashlib.sha256(state.encode()).hexdigest()
    index = SegmentedIndex(t.spark, tables.library_path(t.spark, f"segments-{key}"))
    if index.state == state:
        return index
    language = F.coalesce("type", F.lit(""))
    for batch in (language == "en", language == "de", ~language.isin("en", "de")):
        index.append(docs.filter(batch))
    poor = docs.join(labels.filter("quality = 0").select("doc_id"), "doc_id", "left_semi")
    index.update(poor.withColumn("content", F.concat(F.lit("revised "), F.col("content"))))
    return index.delete(labels.filter("toxic = 1").select("doc_id"), state)


@query("s11_segments_search", f"WITH {REVISED} SELECT doc_id FROM revised WHERE list_has_any({tokens_sql()}, ['license', 'revised'])")
def _(t: Tables):
    return _segments(t).index().keys("license revised")


@query("s11_segments_rank", f"""WITH {REVISED}, {bm25_sql('revised', ['license', 'revised'])}
  SELECT doc_id, round(score, 6) AS score FROM scored""")
def _(t: Tables):
    return _segments(t).index().rank("license revised").select("doc_id", rounded("score"))


@query("s11_segments_totals", f"WITH {REVISED} SELECT count(*) AS docs, coalesce(sum(len({tokens_sql()})), 0)::BIGINT AS words FROM revised")
def _(t: Tables):
    return _segments(t).report().select("docs", "words")


def _positions(t: Tables) -> PositionIndex:
    key = hashlib.sha256(t.folder.encode()).hexdigest()
    return PositionIndex.ensure(t.prose(), tables.library_path(t.spark, f"positions-{key}"))


def phrase_sql(*words: str) -> str:
    """How often a document has the words next to each other."""
    return f"""WITH {PROSE}, words AS (SELECT doc_id, {tokens_sql()} AS w FROM prose),
  counted AS (SELECT doc_id, len(list_filter(range(1, len(w) + 1), lambda i: w[i:i + {len(words) - 1}] = {list(words)})) AS n FROM words)
  SELECT doc_id, n FROM counted WHERE n > 0"""


@query("f17_phrase", phrase_sql("general", "public", "license"))
def _(t: Tables):
    return _positions(t).phrase("General Public License")


@query("f17_phrase_of_one_word", phrase_sql("license"))
def _(t: Tables):
    return _positions(t).phrase("license")


@query("f11_words_within_distance", f"""WITH {PROSE}, words AS (SELECT doc_id, {tokens_sql()} AS w FROM prose),
  counted AS (SELECT doc_id, len(list_filter(range(1, len(w) + 1), lambda i: w[i] = 'license' AND list_contains(w[greatest(i - 5, 1):i - 1], 'gnu'))) AS n FROM words)
  SELECT doc_id, n FROM counted WHERE n > 0""")
def _(t: Tables):
    return _positions(t).in_order("gnu license", 5)


@query("f11_words_in_order", f"""WITH {PROSE}, words AS (SELECT doc_id, {tokens_sql()} AS w FROM prose),
  counted AS (SELECT doc_id, len(list_filter(range(1, len(w) + 1), lambda i: w[i] = 'the' AND i > list_position(w, 'license'))) AS n
    FROM words WHERE list_contains(w, 'license'))
  SELECT doc_id, n FROM counted WHERE n > 0""")
def _(t: Tables):
    return _positions(t).in_order("license the")


def _terms(t: Tables) -> TermDictionary:
    key = hashlib.sha256(t.folder.encode()).hexdigest()
    return TermDictionary.ensure(_stored_index(t), tables.library_path(t.spark, f"terms-{key}"), tables.source_state(t.documents))


def _by_term(name: str, pattern: str) -> None:
    """Keys of the documents with a word of a pattern, from the dictionary."""
    like = pattern.replace("*", "%").replace("?", "_")

    @query(name, f"WITH {PROSE} SELECT doc_id FROM prose WHERE len(list_filter({tokens_sql()}, lambda x: x LIKE '{like}')) > 0")
    def _(t: Tables):
        return _terms(t).keys(pattern)


_by_term("f15_word_pattern", "licen?e*")
_by_term("f15_word_pattern_inside", "*oundat*")
_by_term("f15_word_pattern_both_ends", "w*n?y")


def _trigram_index(t: Tables) -> TrigramIndex:
    key = hashlib.sha256(t.folder.encode()).hexdigest()
    return TrigramIndex.ensure(t.prose(), tables.library_path(t.spark, f"trigrams-{key}"))


def _by_trigrams(name: str, sql_test: str, find_rows) -> None:
    """Keys of the documents that a pattern matches, from the trigram table."""
    @query(name, f"WITH {PROSE} SELECT doc_id FROM prose WHERE {sql_test}")
    def _(t: Tables):
        return find_rows(_trigram_index(t), t.prose()).select("doc_id")


_by_trigrams("f04_trigram_find", "regexp_matches(content, 'licen[cs]e')", lambda i, docs: i.find(docs, LICENSE))
_by_trigrams("f05_trigram_any_case", "regexp_matches(content, 'licen[cs]e', 'i')", lambda i, docs: i.find(docs, LICENSE, "i"))
_by_trigrams("f03_trigram_lower", "regexp_matches(lower(content), 'licen[cs]e')",
             lambda i, docs: i.regex(docs, f"(.*){LICENSE}(.*)", on="lower"))
_by_trigrams("f08_trigram_ip_shape", f"regexp_matches(content, '{IP}')", lambda i, docs: i.find(docs, IP))
_by_trigrams("f10_trigram_email", f"regexp_matches(lower(content), '{MAIL}')", lambda i, docs: i.regex(docs, f"(.*){MAIL}(.*)", on="lower"))
_by_trigrams("f11_trigram_ordered", "regexp_matches(content, 'GNU.*version [0-9]')", lambda i, docs: i.find(docs, "GNU.*version [0-9]"))
_by_trigrams("f11_trigram_across_lines", "regexp_matches(content, 'GNU.*icense', 's')", lambda i, docs: i.regex(docs, "(.*)GNU(.*)icense(.*)"))
_by_trigrams("f12_trigram_anchored", "regexp_matches(content, '^The .*license', 's')", lambda i, docs: i.regex(docs, "The (.*)license(.*)"))
_by_trigrams("f04_trigram_scan", "regexp_matches(content, '[A-Z][a-z][a-z] [0-9]')", lambda i, docs: i.find(docs, "[A-Z][a-z][a-z] [0-9]"))


def _vector(t: Tables, vec_id: int) -> list[float]:
    return t.embeddings.filter(F.col("vec_id") == vec_id).first()["embedding"]


def nearest_sql(score: str, k: int, vec_id: int = 0) -> str:
    return f"""q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = {vec_id}),
best AS (SELECT vec_id, {score} AS score FROM embeddings, q ORDER BY score DESC, vec_id LIMIT {k})"""


COSINE = "list_cosine_similarity(embedding::DOUBLE[], q)"


@query("j02_documents_of_vectors", f"""WITH {PROSE}, {nearest_sql(COSINE, 10)}
  SELECT p.doc_id, p.filename, round(b.score, 6) AS score FROM best b JOIN prose p ON p.doc_id = b.vec_id""")
def _(t: Tables):
    best = nearest(t.embeddings, _vector(t, 0), 10)
    return (t.prose().join(best.withColumnRenamed("vec_id", "doc_id"), "doc_id")
            .select("doc_id", "filename", rounded("score")))


@query("j03_strategy_keys", f"""WITH {PROSE}, l AS (SELECT doc_id FROM prose WHERE regexp_matches(content, '[Ll]icense')),
  r AS (SELECT doc_id FROM prose WHERE {HAS_LICENSE})
  SELECT coalesce(l.doc_id, r.doc_id) AS doc_id, CASE WHEN r.doc_id IS NULL THEN 'left' ELSE 'right' END AS side
  FROM l FULL OUTER JOIN r ON l.doc_id = r.doc_id WHERE l.doc_id IS NULL OR r.doc_id IS NULL""")
def _(t: Tables):
    docs = t.prose()
    return compare_keys(search(docs, find("content", "[Ll]icense")), _stored_index(t).keys("license"))


# ---------------------------------------------------------------- aggregations

@query("a01_facet", f"""WITH {PROSE} SELECT type AS bucket, count(*) AS n FROM prose
  WHERE regexp_matches(content, 'licen[cs]e') GROUP BY type""")
def _(t: Tables):
    rows = facet(t.prose(), find("content", LICENSE), "metadata.type")
    return rows.filter(~F.col("is_total")).select("bucket", "n")


@query("a02_facet_total", f"""WITH {LOGS} SELECT type AS bucket, grouping(type) = 1 AS is_total, count(*) AS n
  FROM logs WHERE regexp_matches(content, '(Exception|Error|WARN)') GROUP BY ROLLUP (type)""")
def _(t: Tables):
    return facet(t.logs(), regex("content", catalogue.TROUBLE), "metadata.type")


@query("a03_hit_count", f"WITH {LOGS} SELECT count(*) AS hits FROM logs WHERE contains(content, 'ERROR')")
def _(t: Tables):
    return count_hits(t.logs(), find("content", "ERROR"))


@query("a04_occurrences", f"""WITH {LOGS} SELECT doc_id, len(regexp_extract_all(content, 'ERROR|WARN')) AS n,
  len(regexp_extract_all(content, 'user')) AS users FROM logs""")
def _(t: Tables):
    return t.logs().select("doc_id", count_matches(F.col("content"), "ERROR|WARN").alias("n"),
                           count_matches(F.col("content"), "user").alias("users"))


# Latency samples: an event is a sample, its type the method, its user the slot.
SAMPLES = """samples AS (SELECT 'group ' || user_id % 10 AS label, event_type AS method, user_id AS slot,
  value AS ms FROM events)"""
SUMMARY = """round(avg(ms), 6) AS avg, round(median(ms), 6) AS median, min(ms) AS min, max(ms) AS max,
  round(coalesce(stddev_samp(ms), 0), 6) AS stdev, count(ms) AS n"""


def _samples(t: Tables) -> DataFrame:
    label = F.concat(F.lit("group "), (F.col("user_id") % 10).cast("string"))
    return t.events.select(label.alias("label"), F.col("event_type").alias("method"),
                           F.col("user_id").alias("slot"), F.col("value").alias("ms"))


def _shown_summary(rows: DataFrame) -> DataFrame:
    fixed = [c for c in rows.columns if c not in ("avg", "median", "stdev")]
    return rows.select(*fixed, rounded("avg"), rounded("median"), rounded("stdev"))


@query("a05_latency_summary", f"WITH {SAMPLES} SELECT method, {SUMMARY} FROM samples GROUP BY method")
def _(t: Tables):
    return _shown_summary(report.latency_summary(_samples(t), by=("method",)))


@query("a06_two_level_means", f"""WITH {SAMPLES}, slots AS (SELECT label, method, slot, avg(ms) AS ms FROM samples
  GROUP BY ALL) SELECT label, method, round(avg(ms), 6) AS avg, round(median(ms), 5) AS median,
  round(coalesce(stddev_samp(ms), 0), 6) AS stdev, count(*) AS n FROM slots GROUP BY label, method""")
def _(t: Tables):
    rows = report.latency_summary(report.slot_means(_samples(t)))
    return rows.select("label", "method", "n", rounded("avg"), rounded("median", 5), rounded("stdev"))


@query("a07_winner", f"""WITH {SAMPLES}, m AS (SELECT label, method, avg(ms) AS avg FROM samples GROUP BY ALL)
  SELECT label, arg_min(method, avg) AS winner, round(max(avg) / min(avg), 6) AS factor FROM m GROUP BY label""")
def _(t: Tables):
    summary = _samples(t).groupBy("label", "method").agg(F.avg("ms").alias("avg"))
    return report.winners(summary).select("label", "winner", rounded("factor"))


@query("a08_percentiles", f"""WITH {SAMPLES} SELECT method, round(quantile_cont(ms, 0.5), 6) AS p50,
  round(quantile_cont(ms, 0.95), 6) AS p95, round(quantile_cont(ms, 0.99), 6) AS p99
  FROM samples GROUP BY method""")
def _(t: Tables):
    rows = report.percentiles(_samples(t), by=("method",))
    return rows.select("method", rounded("p50"), rounded("p95"), rounded("p99"))


# What must hold of the sketches: all samples are in them, and the ranks of their quantiles are near the wanted ones.
@query("a08_sketch_quantiles", """SELECT event_type AS method, month(ts)::INTEGER AS month, count(value) AS n, true AS near FROM events GROUP BY ALL""")
def _(t: Tables):
    key = hashlib.sha256(t.folder.encode()).hexdigest()
    sketches = Sketches.ensure(t.events, tables.library_path(t.spark, f"sketches-{key}"), "event_type", F.to_date("ts"), "value")
    wanted = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = sketches.quantiles(wanted, period=F.month("day"))
    rows = t.events.select(F.col("event_type").alias("name"), F.month("ts").alias("period"), "value").join(found, ["name", "period"])
    below = rows.groupBy("name", "period", "n").agg(F.count("value").alias("samples"), *[
        F.count_if(F.col("value") <= F.col(q)).alias(f"{q}_most") for q in wanted], *[
        F.count_if(F.col("value") < F.col(q)).alias(f"{q}_least") for q in wanted])
    slack = RANK_ERROR * F.col("n") + 1
    near = [(F.col(f"{q}_least") <= share * F.col("n") + slack) & (F.col(f"{q}_most") >= share * F.col("n") - slack) for q, share in wanted.items()]
    return below.select(F.col("name").alias("method"), F.col("period").alias("month"), "n",
                        (near[0] & near[1] & near[2] & (F.col("samples") == F.col("n"))).alias("near"))


@query("a09_parity", f"""WITH {PROSE}, h AS (SELECT regexp_matches(lower(content), 'license') AS b,
    {HAS_LICENSE} AS s0, contains(content, 'license') AS s1 FROM prose)
  SELECT 'text' AS strategy, count(*) FILTER (s0) AS hits, count(*) FILTER (b) AS baseline_hits, count(*) FILTER (b AND NOT s0) AS only_baseline,
    count(*) FILTER (s0 AND NOT b) AS only_strategy, count(*) FILTER (b <> s0) = 0 AS same FROM h
  UNION ALL SELECT 'contains', count(*) FILTER (s1), count(*) FILTER (b), count(*) FILTER (b AND NOT s1), count(*) FILTER (s1 AND NOT b),
    count(*) FILTER (b <> s1) = 0 FROM h""")
def _(t: Tables):
    return parity(t.prose(), regex("content", "(.*)license(.*)", on="lower"),
                  {"text": text("content", "license"), "contains": contains("content", "license")})


@query("a10_report_sections", f"""WITH {SAMPLES}, r AS (SELECT label, CASE WHEN label = 'group 9' THEN 'negation'
    WHEN label IN ('group 0', 'group 1', 'group 2', 'group 3', 'group 4', 'group 5') THEN 'dense' ELSE 'selective' END
    AS section, avg(ms) AS avg FROM samples GROUP BY label)
  SELECT section, count(*) AS results, round(min(avg), 6) AS fastest FROM r GROUP BY section""")
def _(t: Tables):
    number = F.substring("label", 7, 1).cast("int")
    limit = F.when(number <= 5, F.lit(catalogue.SCENARIO_LIMIT)).otherwise(F.lit(0))
    results = (_samples(t).groupBy("label").agg(F.avg("ms").alias("avg"))
               .withColumn("section", report.section(limit, number == 9)))
    return results.groupBy("section").agg(F.count("*").alias("results"),
                                          F.round(F.min("avg"), 6).alias("fastest"))


# ---------------------------------------------------------------- limits and sets

@query("l01_limit", f"""WITH {LOGS} SELECT doc_id FROM logs WHERE contains(content, 'ERROR') ORDER BY doc_id LIMIT 10""")
def _(t: Tables):
    return first(t.logs(), regex("content", catalogue.ERROR), catalogue.EXAMPLE_LIMIT)


@query("l02_limit_zero_is_all", f"WITH {LOGS} SELECT doc_id FROM logs WHERE contains(content, 'WARN')")
def _(t: Tables):
    return search(t.logs(), find("content", "WARN"), limit=0)


@query("l03_limit_override", f"""WITH {LOGS} (SELECT 'default' AS kind, doc_id FROM logs WHERE contains(content, 'WARN')
  ORDER BY doc_id LIMIT 20) UNION ALL SELECT 'all', doc_id FROM logs WHERE regexp_matches(content, '{KEY69}')""")
def _(t: Tables):
    docs = t.logs()
    kinds = (("default", find("content", "WARN"), None), ("all", find("content", KEY69), 0))
    parts = [first(docs, hit, resolve_limit(override, catalogue.SCENARIO_LIMIT))
             .select(F.lit(kind).alias("kind"), "doc_id") for kind, hit, override in kinds]
    return parts[0].unionByName(parts[1])


@query("l04_top_by_score", f"""WITH {PROSE}, {bm25_sql('prose', ['license', 'gnu'])}
  SELECT doc_id, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, doc_id LIMIT 10""")
def _(t: Tables):
    best = top(t.prose(), text("content", "license gnu", stats=_stored_index(t).stats("license gnu")), 10)
    return best.select("doc_id", rounded("score"))


@query("e01_set_difference", f"""WITH {PROSE} SELECT doc_id FROM prose WHERE regexp_matches(lower(content), 'license')
  EXCEPT ALL SELECT doc_id FROM prose WHERE {HAS_LICENSE}""")
def _(t: Tables):
    docs = t.prose()
    return difference(search(docs, regex("content", "(.*)license(.*)", on="lower")),
                      search(docs, text("content", "license")))


# ---------------------------------------------------------------- scalar functions

@query("h01_find_all", f"""WITH {PROSE} SELECT doc_id, array_to_string(regexp_extract_all(content, '{IP}'), '|') AS found
  FROM prose WHERE regexp_matches(content, '{IP}')""")
def _(t: Tables):
    return search(t.prose(), find("content", IP), ("doc_id", joined(find_all(F.col("content"), IP)).alias("found")))


# Place of the n-th match: the length of everything before it, cut at the pattern.
RECORDS = f"""{PROSE}, cut AS (SELECT doc_id, regexp_split_to_array(content, '{MAIL}') AS pieces,
    regexp_extract_all(content, '{MAIL}') AS found, regexp_extract_all(content, '{MAIL.replace('@[a-z0-9]+', '@([a-z0-9]+)')}', 1) AS hosts
  FROM prose WHERE regexp_matches(content, '{MAIL}'))
SELECT doc_id, n AS nth, found[n] AS match, hosts[n] AS host,
  (list_sum(list_transform(pieces[1:n], lambda x: length(x))) +
   coalesce(list_sum(list_transform(found[1:n - 1], lambda x: length(x))), 0))::BIGINT AS idx
FROM (SELECT *, unnest(range(1, len(found) + 1)) AS n FROM cut)"""


@query("h01_find_records", f"WITH {RECORDS}")
def _(t: Tables):
    pattern = MAIL.replace("@[a-z0-9]+", "@([a-z0-9]+)")
    records = search(t.prose(), find("content", pattern),
                     ("doc_id", F.posexplode(find_records(F.col("content"), pattern)).alias("pos", "m")))
    return records.select("doc_id", (F.col("pos") + 1).cast("long").alias("nth"), "m.match",
                          F.col("m.captures")[0].alias("host"), F.col("m.idx").cast("long").alias("idx"))


@query("h02_split_lines", """SELECT doc_id, len(string_split(text, chr(10))) AS n_lines,
  string_split(text, chr(10))[1] AS first_line FROM documents""")
def _(t: Tables):
    lines = split_lines(F.col("text"))
    return t.documents.select("doc_id", F.size(lines).cast("long").alias("n_lines"), lines[0].alias("first_line"))


@query("h03_matching_lines", f"""WITH {LOGS} SELECT doc_id, array_to_string(
  list_filter(string_split(content, chr(10)), lambda x: regexp_matches(x, 'ERROR|WARN')), chr(10)) AS lines
  FROM logs WHERE regexp_matches(content, 'ERROR|WARN')""")
def _(t: Tables):
    lines = joined(matching_lines(F.col("content"), "ERROR|WARN"), "\n").alias("lines")
    return search(t.logs(), find("content", "ERROR|WARN"), ("doc_id", lines))


@query("h04_line_view", f"""WITH {LOGS}, l AS (SELECT doc_id, string_split(content, chr(10)) AS a FROM logs),
  n AS (SELECT doc_id, unnest(range(1, len(a) + 1)) AS line_no, a FROM l)
  SELECT doc_id, line_no, a[line_no] AS line FROM n WHERE contains(a[line_no], 'ERROR')""")
def _(t: Tables):
    return line_view(t.logs(), "ERROR")


@query("h05_regex_test", f"WITH {LOGS} SELECT doc_id, regexp_matches(content, 'WARN.*k') AS hit FROM logs")
def _(t: Tables):
    return t.logs().select("doc_id", compile_pattern("WARN.*k").test(F.col("content")).alias("hit"))


@query("h06_array_size", f"""WITH {PROSE} SELECT doc_id, len(regexp_extract_all(content, '[0-9]+')) AS n FROM prose""")
def _(t: Tables):
    return t.prose().select("doc_id", F.size(find_all(F.col("content"), "[0-9]+")).cast("long").alias("n"))


@query("h07_tokens", f"SELECT doc_id, array_to_string(regexp_extract_all(lower(text), {WORDS}), ' ') AS words FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", joined(tokens(F.col("text")), " ").alias("words"))


# The words of the standard rule for scripts that the texts have: letters joined across marks between them, digits likewise.
STANDARD_WORDS = r"""'(?:[\p{L}\p{Nl}][\p{L}\p{Nl}\p{M}\x{200C}\x{200D}\x{AD}]*(?:[:·.‘’․''][\p{L}\p{Nl}][\p{L}\p{Nl}\p{M}\x{200C}\x{200D}\x{AD}]*)*|\p{Nd}[\p{Nd}\p{M}]*(?:[,;.‘’․''\x{66C}]\p{Nd}[\p{Nd}\p{M}]*)*|\p{Pc}\p{M}*)+'"""


def standard_sql(value: str = "content") -> str:
    return f"list_filter(regexp_extract_all(lower({value}), {STANDARD_WORDS}), lambda x: regexp_matches(x, '[^\\p{{Pc}}\\p{{M}}]'))"


@query("h07_standard_tokens", f"SELECT doc_id, array_to_string({standard_sql('text')}, ' ') AS words FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", joined(tokens(F.col("text"), "standard"), " ").alias("words"))


@query("f16_text_standard_word", f"WITH {PROSE} SELECT doc_id FROM prose WHERE list_has_any({standard_sql()}, ['example.com', 'isn''t', 'gnu'])")
def _(t: Tables):
    return search(t.prose(), text("content", "example.com isn't GNU", rule="standard"))


@query("h08_lower", "SELECT doc_id, lower(text) AS text_lc FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", F.lower("text").alias("text_lc"))


@query("h09_formatting", """SELECT event_id, printf('doc_%05d.txt', event_id + 1) AS filename,
  printf('CRIT-%04d', user_id) AS code, printf('v%d.%d.%d', user_id, event_id % 13, event_id % 21) AS version FROM events""")
def _(t: Tables):
    event, user = F.col("event_id"), F.col("user_id")
    return t.events.select("event_id", F.format_string("doc_%05d.txt", event + 1).alias("filename"),
                           F.format_string("CRIT-%04d", user).alias("code"),
                           F.format_string("v%d.%d.%d", user, event % 13, event % 21).alias("version"))


NORM = "sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)))"


@query("h10_norm", f"SELECT vec_id, round({NORM}, 6) AS norm FROM embeddings")
def _(t: Tables):
    return t.embeddings.select("vec_id", F.round(vectors.norm(F.col("embedding")), 6).alias("norm"))


@query("h10_unit_vector", f"""SELECT vec_id, pos, round(embedding[pos]::DOUBLE / size, 6) AS x FROM
  (SELECT vec_id, embedding, {NORM} AS size, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)""")
def _(t: Tables):
    parts = t.embeddings.select("vec_id", F.posexplode(vectors.unit(F.col("embedding"))).alias("pos", "x"))
    return parts.select("vec_id", (F.col("pos") + 1).cast("long").alias("pos"), rounded("x"))


# Square roots have no ties; on a tie Spark rounds up the shortest decimal form, DuckDB the binary one.
@query("h11_rounding", """SELECT event_id, round(sqrt(value), 1) AS ms, round(sqrt(value), 4) AS score FROM events""")
def _(t: Tables):
    return t.events.select("event_id", report.shown(F.sqrt("value")).alias("ms"),
                           report.shown(F.sqrt("value"), 4).alias("score"))


# ---------------------------------------------------------------- vectors and ranking

def _register_metric(name: str, metric: str, score: str) -> None:
    @query(name, f"WITH {nearest_sql(score, 10)} SELECT vec_id, round(score, 6) AS score FROM best")
    def _(t: Tables):
        return nearest(t.embeddings, _vector(t, 0), 10, metric).select("vec_id", rounded("score"))


_register_metric("v02_nearest_cosine", "cosine", COSINE)
_register_metric("v03_nearest_dot", "dot", "list_inner_product(embedding::DOUBLE[], q)")
_register_metric("v03_nearest_euclidean", "euclidean", "0 - list_distance(embedding::DOUBLE[], q)")


def batch_sql(score: str, k: int) -> str:
    """The k best of all vectors for every row whose id 20 divides."""
    return f"""WITH s AS (SELECT a.vec_id AS query_id, e.vec_id, {score} AS score
    FROM (SELECT vec_id, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 20 = 0) a, embeddings e),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
  SELECT query_id, vec_id, round(score, 6) AS score, rank FROM r WHERE rank <= {k}"""


@query("v02_nearest_batch", batch_sql(COSINE, 5))
def _(t: Tables):
    best = nearest_batch(t.embeddings, t.embeddings.filter(F.col("vec_id") % 20 == 0), 5)
    return best.select("query_id", "vec_id", "rank", rounded("score"))


def _vector_index(t: Tables, metric: str = "cosine") -> VectorIndex:
    key = hashlib.sha256(t.folder.encode()).hexdigest()
    return VectorIndex.ensure(t.embeddings, tables.library_path(t.spark, f"vectors-{metric}-{key}"), metric)


def _asked(t: Tables) -> DataFrame:
    return t.embeddings.filter(F.col("vec_id") % 20 == 0)


def _register_index(name: str, metric: str, score: str) -> None:
    @query(name, batch_sql(score, 10))
    def _(t: Tables):
        best = _vector_index(t, metric).search_exact(_asked(t), 10)
        return best.select("query_id", "vec_id", "rank", rounded("score"))


_register_index("v02_index_exact", "cosine", COSINE)
_register_index("v03_index_exact_dot", "dot", "list_inner_product(e.embedding::DOUBLE[], q)")
_register_index("v03_index_exact_euclidean", "euclidean", "0 - list_distance(e.embedding::DOUBLE[], q)")


# What must hold of the approximate search: all queries answered in full, and nine of ten neighbours found.
@query("v02_index_recall", """SELECT count(*) AS queries, (count(*) * least(10, (SELECT count(*) FROM embeddings)))::BIGINT AS returned,
  true AS recall_reached FROM embeddings WHERE vec_id % 20 = 0""")
def _(t: Tables):
    index, asked = _vector_index(t), _asked(t)
    found, exact = index.search(asked, 10), nearest_batch(t.embeddings, asked, 10)
    true = exact.select("query_id", "vec_id", F.lit(True).alias("true"))
    rows = found.join(true, ["query_id", "vec_id"], "left")
    return rows.agg(F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("returned"),
                    (F.count("true") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"))


@query("v04_bm25", f"""WITH {PROSE}, {bm25_sql('prose', ['license', 'gnu', 'software'])}
  SELECT doc_id, round(score, 6) AS score FROM scored""")
def _(t: Tables):
    return _stored_index(t).rank("license GNU software").select("doc_id", rounded("score"))


@query("v04_bm25_from_index", f"""WITH {PROSE}, {bm25_sql('prose', ['license', 'gnu'])}
  SELECT doc_id, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, doc_id LIMIT 20""")
def _(t: Tables):
    return _stored_index(t).rank("license gnu", 20).select("doc_id", rounded("score"))


def _block_index(t: Tables) -> BlockIndex:
    key = hashlib.sha256(t.folder.encode()).hexdigest()
    return BlockIndex.ensure(t.prose(), tables.library_path(t.spark, f"blocks-{key}"))


def _by_blocks(name: str, *words: str, limit: int = 10) -> None:
    @query(name, f"""WITH {PROSE}, {bm25_sql('prose', list(words))}
  SELECT doc_id, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, doc_id LIMIT {limit}""")
    def _(t: Tables):
        return _block_index(t).rank(" ".join(words), limit).select("doc_id", rounded("score"))


_by_blocks("l04_top_by_blocks", "license", "gnu")
_by_blocks("l04_top_by_blocks_common", "the", "license")
_by_blocks("v04_best_by_blocks", "software", "foundation", "version", limit=20)


# ---------------------------------------------------------------- bitmaps

def _bitmaps(t: Tables) -> BitmapIndex:
    key = hashlib.sha256(t.folder.encode()).hexdigest()
    return BitmapIndex.ensure(t.prose(), tables.library_path(t.spark, f"bitmaps-{key}"), ("metadata.type", "metadata.server"))


LICENSED = Words("license") & ~Words("gnu") | Words("foundation") & Words("the")
LICENSED_SQL = (f"((list_contains({tokens_sql()}, 'license') AND NOT list_contains({tokens_sql()}, 'gnu')) "
                f"OR (list_contains({tokens_sql()}, 'foundation') AND list_contains({tokens_sql()}, 'the')))")


@query("a03_bitmap_count", f"WITH {PROSE} SELECT count(*) AS hits FROM prose WHERE {LICENSED_SQL}")
def _(t: Tables):
    return _bitmaps(t).count(LICENSED)


@query("c03_bitmap_keys", f"WITH {PROSE} SELECT doc_id FROM prose WHERE {LICENSED_SQL}")
def _(t: Tables):
    return _bitmaps(t).keys(LICENSED)


@query("a01_bitmap_facet", f"""WITH {PROSE} SELECT server AS bucket, grouping(server) = 1 AS is_total, count(*) AS n
  FROM prose WHERE {LICENSED_SQL} GROUP BY ROLLUP (server)""")
def _(t: Tables):
    return _bitmaps(t).facet(LICENSED, "metadata.server")


@query("a02_bitmap_facet_common", f"""WITH {PROSE} SELECT type AS bucket, grouping(type) = 1 AS is_total, count(*) AS n
  FROM prose WHERE NOT list_contains({tokens_sql()}, 'the') GROUP BY ROLLUP (type)""")
def _(t: Tables):
    return _bitmaps(t).facet(~Words("the"), "metadata.type")


# ---------------------------------------------------------------- web pages and conversations

LINK = 'href="[^"]+"'


@query("pages_addresses", f"""SELECT page_id, array_to_string(regexp_extract_all(html, '{IP}'), '|') AS ips
  FROM pages WHERE regexp_matches(html, '{IP}')""")
def _(t: Tables):
    found = joined(find_all(F.col("html"), IP)).alias("ips")
    return search(t.pages, find("html", IP), ("page_id", found))


@query("pages_link_counts", f"""SELECT page_id, len(regexp_extract_all(html, '{LINK}')) AS links,
  array_to_string(list_distinct(list_transform(regexp_extract_all(html, '{LINK}')[1:1], lambda x: lower(x))), '') AS first_link
  FROM pages WHERE regexp_matches(html, '<a {LINK}')""")
def _(t: Tables):
    columns = ("page_id", count_matches(F.col("html"), LINK).alias("links"),
               F.coalesce(F.lower(F.get(find_all(F.col("html"), LINK), F.lit(0))), F.lit("")).alias("first_link"))
    return search(t.pages, find("html", f"<a {LINK}"), columns)


@query("pages_facet_by_host", r"""WITH h AS (SELECT regexp_extract(url, '^https?://([^/]+)/', 1) AS host, html FROM pages)
  SELECT host AS bucket, grouping(host) = 1 AS is_total, count(*) AS n FROM h
  WHERE contains(html, '<article>') GROUP BY ROLLUP (host)""")
def _(t: Tables):
    host = F.regexp_extract("url", "^https?://([^/]+)/", 1)
    return facet(t.pages.select(host.alias("host"), "html"), find("html", "<article>"), "host")


@query("conversations_matching_lines", r"""SELECT conv_id, turn, array_to_string(list_filter(string_split(text, chr(10)),
  lambda x: regexp_matches(x, '[Tt]he [a-z]+,')), chr(10)) AS lines FROM conversations
  WHERE regexp_matches(text, '[Tt]he [a-z]+,')""")
def _(t: Tables):
    pattern = "[Tt]he [a-z]+,"
    lines = joined(matching_lines(F.col("text"), pattern), "\n").alias("lines")
    return search(t.conversations, find("text", pattern), ("conv_id", "turn", lines))


@query("conversations_words_by_role", f"""SELECT role AS bucket, grouping(role) = 1 AS is_total, count(*) AS n
  FROM conversations WHERE list_has_all({tokens_sql('text')}, ['the', 'on']) GROUP BY ROLLUP (role)""")
def _(t: Tables):
    return facet(t.conversations, text("text", "the on", mode="all"), "role")


# ---------------------------------------------------------------- the catalogue

@query("ex01_error_dates", f"""WITH {LOGS} SELECT doc_id, filename, content, type FROM logs
  WHERE regexp_matches(content, 'ERROR {DATE}')""")
def _(t: Tables):
    return catalogue.error_dates(t.logs()).select("doc_id", "filename", "content", "metadata.type")


@query("ex02_emails", f"""WITH {PROSE} SELECT doc_id, content, 1.0::DOUBLE AS score,
  array_to_string(regexp_extract_all(content, '{MAIL}', 0, 'i'), '|') AS emails FROM prose
  WHERE regexp_matches(lower(content), '{MAIL}')""")
def _(t: Tables):
    return catalogue.emails(t.prose(), pattern=f"(.*){MAIL}(.*)", extracted=MAIL).select(
        "doc_id", "content", "score", joined(F.col("matched_emails.match")).alias("emails"))


@query("ex03_json_field", f"""WITH {LOGS} SELECT doc_id, content, 1.0::DOUBLE AS score FROM logs
  WHERE regexp_matches(content, '{KEY69}')""")
def _(t: Tables):
    return catalogue.json_field(t.logs(), pattern=r'(.*)(\"k\":[ ]*69)(.*)').select("doc_id", "content", "score")


@query("ex04_trouble", f"""WITH {LOGS} SELECT doc_id, content, 1.0::DOUBLE AS score FROM logs
  WHERE regexp_matches(content, '(Exception|Error|WARN)')""")
def _(t: Tables):
    return catalogue.trouble(t.logs()).select("doc_id", "content", "score")


@query("ex05_error_lines", f"""WITH {LOGS} SELECT doc_id, type, array_to_string(
    list_filter(string_split(content, chr(10)), lambda x: contains(x, 'ERROR')), chr(10)) AS error_lines,
  len(regexp_extract_all(content, 'ERROR')) AS error_count, 1.0::DOUBLE AS score
  FROM logs WHERE contains(content, 'ERROR')""")
def _(t: Tables):
    found = matching_log_lines(t.events, lambda line: line.contains("ERROR"), lambda line: count_matches(line, "ERROR"))
    return found.select("doc_id", "metadata.type", joined(F.col("lines"), "\n").alias("error_lines"),
                        F.col("n").alias("error_count"), F.lit(1.0).alias("score"))


@query("ex06_addresses", f"""WITH {PROSE} SELECT doc_id,
  array_to_string(regexp_extract_all(content, '{IP}'), '|') AS ips, 1.0::DOUBLE AS score FROM prose
  WHERE regexp_matches(content, '{IP}')""")
def _(t: Tables):
    return catalogue.addresses(t.prose()).select(
        "doc_id", joined(F.col("ip_addresses.match")).alias("ips"), "score")


@query("ex07_without_error", f"""WITH {LOGS} SELECT doc_id, content, 0.0::DOUBLE AS score FROM logs
  WHERE content IS NOT NULL AND NOT contains(content, 'ERROR')""")
def _(t: Tables):
    return catalogue.without_error(t.logs()).select("doc_id", "content", "score")


@query("ex08_text_against_regex", f"""WITH {LOGS}, h AS (SELECT contains(content, 'ERROR') AS b,
    list_contains({tokens_sql()}, 'error') AS s FROM logs)
  SELECT 'text' AS strategy, count(*) FILTER (s) AS hits, count(*) FILTER (b) AS baseline_hits, count(*) FILTER (b AND NOT s) AS only_baseline,
    count(*) FILTER (s AND NOT b) AS only_strategy, count(*) FILTER (b <> s) = 0 AS same FROM h""")
def _(t: Tables):
    return catalogue.text_against_regex(t.logs())


@query("ex08_text_hits", f"""WITH {LOGS}, {bm25_sql('logs', ['error'])} SELECT s.doc_id, filename, type, server,
  round(s.score, 6) AS score FROM scored s JOIN logs USING (doc_id)""")
def _(t: Tables):
    return catalogue.text_hits(t.logs(), index=_log_index(t)).select("doc_id", "filename", "metadata.type", "metadata.server", rounded("score"))


@query("ex08_regex_hits", f"""WITH {LOGS} SELECT doc_id, filename, type, server, 1.0::DOUBLE AS score FROM logs
  WHERE contains(content, 'ERROR')""")
def _(t: Tables):
    return catalogue.regex_hits(t.logs()).select("doc_id", "filename", "metadata.type", "metadata.server", "score")


@query("ex09_trouble_by_type", f"""WITH {LOGS} SELECT type AS bucket, grouping(type) = 1 AS is_total, count(*) AS n
  FROM logs WHERE regexp_matches(content, '(Exception|Error|WARN)') GROUP BY ROLLUP (type)""")
def _(t: Tables):
    return catalogue.trouble_by_type(t.logs())


@query("ex10_warn_dates", f"""WITH {LOGS} SELECT doc_id, content, 1.0::DOUBLE AS score FROM logs
  WHERE list_contains({tokens_sql()}, 'warn') AND regexp_matches(content, 'WARN {DATE}')""")
def _(t: Tables):
    return catalogue.warn_dates(t.logs(), index=_log_index(t)).select("doc_id", "content", "score")


# The benchmark scenarios. Each compares strategies with the unanchored pattern on a table that has hits.

def _words_sql(*words: str) -> str:
    return f"list_has_any({tokens_sql()}, [{', '.join(map(repr, words))}])"


def _strategies(name: str, docs: str, base: tuple, forms: dict[str, tuple]) -> None:
    """Registers a report of ``(clause, SQL test)`` pairs on log documents or prose."""
    source = {"prose": PROSE, "logs": LOGS}[docs]
    tests = ", ".join(f"({test}) AS s{i}" for i, (_, test) in enumerate(forms.values()))
    rows = " UNION ALL ".join(
        f"""SELECT '{form}' AS strategy, count(*) FILTER (s{i}) AS hits, count(*) FILTER (b) AS baseline_hits,
        count(*) FILTER (b AND NOT s{i}) AS only_baseline, count(*) FILTER (s{i} AND NOT b) AS only_strategy,
        count(*) FILTER (b <> s{i}) = 0 AS same FROM h""" for i, form in enumerate(forms))

    @query(name, f"WITH {source}, h AS (SELECT ({base[1]}) AS b, {tests} FROM {docs}) {rows}")
    def _(t: Tables):
        return parity(getattr(t, docs)(), base[0](), {form: make() for form, (make, _) in forms.items()})


def _both(pattern: str, words: str) -> Callable[[], Clause]:
    return lambda: compound(filter=[text("content", words)], must=[regex("content", pattern)])


ALTERNATION, DATED = "regexp_matches(content, '(Exception|Error|WARN)')", f"regexp_matches(content, '{DATE}')"
_strategies("scenario01_strategies", "logs", (lambda: find("content", "ERROR"), "contains(content, 'ERROR')"), {
    "whole": (lambda: regex("content", "(.*)ERROR(.*)"), "contains(content, 'ERROR')"),
    "compound": (_both("(.*)ERROR(.*)", "ERROR"), f"{_words_sql('error')} AND contains(content, 'ERROR')"),
    "text": (lambda: text("content", "ERROR"), _words_sql("error"))})
_strategies("scenario02_strategies", "logs", (lambda: find("content", DATE), DATED), {
    "whole": (lambda: regex("content", f"(.*){DATE}(.*)"), DATED)})
_strategies("scenario03_strategies", "prose", (lambda: find("content", "license", "i"), "regexp_matches(content, 'license', 'i')"), {
    "whole": (lambda: regex("content", "(.*)license(.*)", on="lower"), "contains(lower(content), 'license')"),
    "compound": (lambda: compound(filter=[text("content", "license")], must=[regex("content", "(.*)license(.*)", on="lower")]),
                 f"{_words_sql('license')} AND contains(lower(content), 'license')")})
_strategies("scenario04_strategies", "logs", (lambda: find("content", "(Exception|Error|WARN)"), ALTERNATION), {
    "whole": (lambda: regex("content", catalogue.TROUBLE), ALTERNATION),
    "compound": (_both(catalogue.TROUBLE, "Exception Error WARN"), f"{_words_sql('exception', 'error', 'warn')} AND {ALTERNATION}")})
_strategies("scenario05_strategies", "prose", (lambda: find("content", IP), HAS_IP), {
    "whole": (lambda: regex("content", f"(.*){IP}(.*)"), HAS_IP)})
_strategies("scenario06_strategies", "logs", (lambda: find("content", '"k":[ ]*[0-9]+'), """regexp_matches(content, '"k":[ ]*[0-9]+')"""), {
    "whole": (lambda: regex("content", r'(.*)(\"k\":[ ]*[0-9]+)(.*)'), """regexp_matches(content, '"k":[ ]*[0-9]+')""")})
_strategies("scenario07_strategies", "logs", (lambda: find("content", "ERROR.*69"), "regexp_matches(content, 'ERROR.*69')"), {
    "whole": (lambda: regex("content", "(.*)ERROR(.*)69(.*)"), "regexp_matches(content, 'ERROR.*69', 's')"),
    "compound": (_both("(.*)ERROR(.*)69(.*)", "69"), f"{_words_sql('69')} AND regexp_matches(content, 'ERROR.*69', 's')")})
_strategies("scenario08_strategies", "logs", (lambda: find("content", "ERROR.*WARN", "s"), "regexp_matches(content, 'ERROR.*WARN', 's')"), {
    "whole": (lambda: regex("content", "ERROR(.*)WARN(.*)"), "regexp_matches(content, '^ERROR.*WARN', 's')"),
    "compound": (_both("ERROR(.*)WARN(.*)", "ERROR WARN"), f"{_words_sql('error', 'warn')} AND regexp_matches(content, '^ERROR.*WARN', 's')")})
GNU = "GNU General Public License, version [0-9]"
_strategies("scenario09_strategies", "prose", (lambda: find("content", GNU), f"regexp_matches(content, '{GNU}')"), {
    "whole": (lambda: regex("content", f"(.*){GNU}(.*)"), f"regexp_matches(content, '{GNU}')"),
    "compound": (_both(f"(.*){GNU}(.*)", "GNU version"), f"{_words_sql('gnu', 'version')} AND regexp_matches(content, '{GNU}')")})
_strategies("scenario10_strategies", "logs", (lambda: find_not("content", "ERROR"), "NOT contains(content, 'ERROR')"), {
    "whole": (lambda: compound(filter=[wildcard("content", "*")], must_not=[regex("content", "(.*)ERROR(.*)")]),
              "NOT contains(content, 'ERROR')")})


def _load_sql() -> str:
    def word(text: str) -> str:
        return f"list_contains({tokens_sql()}, '{text.lower()}')"

    tests = {f"regex/{n}": f"regexp_matches(content, '{p}')" for n, p in catalogue.LOAD_FIND}
    tests |= {f"regex_not/{n}": f"NOT regexp_matches(content, '{p}')" for n, p in catalogue.LOAD_FIND_NOT}
    tests |= {f"search_regex/{n}": f"regexp_full_match(content, '{p}', 's')" for n, p in catalogue.LOAD_WHOLE}
    tests |= {f"compound/{n}": f"{word(w)} AND regexp_full_match(content, '{p}', 's')"
              for n, p, w in catalogue.LOAD_COMPOUND}
    tests |= {f"text/{n}": word(w) for n, w in catalogue.LOAD_TEXT}
    tests |= {f"search_must_not/{n}": f"NOT regexp_full_match(content, '{p}', 's')"
              for n, p in catalogue.LOAD_WHOLE_NOT}
    return f"WITH {LOGS} " + " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) FILTER ({test}) AS hits FROM logs" for name, test in tests.items())


@query("load_catalogue_hits", _load_sql())
def _(t: Tables):
    return catalogue.hit_counts(t.logs(), catalogue.load_clauses())
