"""A stored table of word occurrences, and text search on it."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.functions.runs import in_parts, runs
from logsieve.functions.text import SIMPLE, has_words, query_terms, tokens
from logsieve.operators.fetch import fetch
from logsieve.operators.relevance import CorpusStats, stats_from
from logsieve.sources.tables import source_state
from logsieve.sources.versions import Versions


# The token of the row that stands for a document as a whole; rows that a task sorts for one file.
DOCUMENT, ROWS_PER_FILE = "", 1_000_000


def token_table(docs: DataFrame, content: str = "content", key: str = "doc_id", mark_documents: bool = False,
                rule: str = SIMPLE) -> DataFrame:
    """Rows ``(token, key, tf, dl)``: a word, a document, its count there, the document's length.

    A document is one row, so its words are counted inside its batch of rows: equal words of a
    document become a run, and its length is the count. Nothing is shuffled.
    With ``mark_documents`` each document also has a row for the empty word, which is no word
    of any text: texts are cut once for the words and for the statistics of documents.
    """
    kind = docs.schema[key].dataType.simpleString()
    words = docs.filter(F.col(content).isNotNull()).select(key, tokens(F.col(content), rule).alias("words"))

    def count(batches):
        for batch in batches:
            found, sizes = runs(batch.column("words")), batch.column("words").value_lengths().to_numpy()
            token, doc, tf = found.token, found.doc, np.diff(found.bounds)
            if mark_documents:
                n = batch.num_rows
                token = pa.concat_arrays([pa.array([DOCUMENT] * n, pa.string()), token])
                doc, tf = np.concatenate([np.arange(n), doc]), np.concatenate([np.zeros(n, np.int64), tf])
            rows = pa.RecordBatch.from_arrays([token, batch.column(key).take(pa.array(doc)), pa.array(tf, pa.int32()), pa.array(
                sizes[doc], pa.int32())], names=["token", key, "tf", "dl"])
            yield from in_parts(rows)

    return words.mapInArrow(count, f"token string, `{key}` {kind}, tf int, dl int")


def totals(docs: DataFrame, content: str = "content", rule: str = SIMPLE) -> DataFrame:
    """One row ``(n, words)``: documents and words in the corpus."""
    sizes = docs.filter(F.col(content).isNotNull()).select(F.size(tokens(F.col(content), rule)).alias("dl"))
    return sizes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("words"))


def write_rows(rows: DataFrame, path: str, key: str = "doc_id", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Store marked rows as ``postings``, sorted, ``documents`` (key, dl) and ``corpus`` (n, words)."""
    spark, unsorted = rows.sparkSession, f"{path}/unsorted"
    rows.write.mode("overwrite").parquet(unsorted)
    written = spark.read.parquet(unsorted)
    files = max(1, written.count() // rows_per_file)
    (written.filter(F.col("token") != DOCUMENT).repartitionByRange(files, "token", key)
     .sortWithinPartitions("token", key).write.mode("overwrite").parquet(f"{path}/postings"))
    written.filter(F.col("token") == DOCUMENT).select(key, "dl").write.mode("overwrite").parquet(f"{path}/documents")
    documents = spark.read.parquet(f"{path}/documents")
    documents.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("words")).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/corpus")
    spark.createDataFrame([], written.schema).write.mode("overwrite").parquet(unsorted)


@dataclass(frozen=True)
class TokenIndex:
    postings: DataFrame
    corpus: DataFrame
    key: str = "doc_id"
    current: bool = False  # whether the index is known to hold the words of the documents as they are
    rows: DataFrame | None = None  # what is to be stored: postings and a marked row for each document
    rule: str = SIMPLE             # by which texts and queries are cut into words

    @staticmethod
    def of(docs: DataFrame, content: str = "content", key: str = "doc_id", rule: str = SIMPLE) -> "TokenIndex":
        """An index computed on the fly."""
        return TokenIndex(token_table(docs, content, key, rule=rule), totals(docs, content, rule), key, True,
                          token_table(docs, content, key, True, rule), rule)

    @staticmethod
    def ensure(docs: DataFrame, path: str, content: str = "content", key: str = "doc_id", rule: str = SIMPLE) -> "TokenIndex":
        """The newest version of the stored index if it was made from these documents as they are, else a new one.

        Later applications find it again.
        """
        spark, state = docs.sparkSession, f"{content}, {key}, {rule}: {source_state(docs)}"
        folder = Versions(spark, path).ensure(state, TokenIndex.of(docs, content, key, rule).save)
        return replace(TokenIndex.load(spark, folder, key), current=True, rule=rule)

    @staticmethod
    def load(spark: SparkSession, path: str, key: str = "doc_id") -> "TokenIndex":
        return TokenIndex(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/corpus"), key)

    def save(self, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
        """Write the index sorted by word, so that a lookup reads only the files of its words.

        Files are ranges of (word, key), not of words alone: a word that is in every document
        is spread over many files instead of filling one task. Finding the ranges takes a pass
        of its own, so the words are first written as they come: texts are cut into words once,
        and a lost executor does not cost that work again. The unsorted copy is emptied at the end.
        """
        write_rows(self.rows, path, self.key, rows_per_file)

    def lookup(self, query: str) -> DataFrame:
        """The occurrences of a query's words; the word filter reaches the scan."""
        return self.postings.filter(F.col("token").isin(query_terms(query, self.rule)))

    def keys(self, query: str, mode: str = "any") -> DataFrame:
        """Keys of the documents that hold any (or all) of the words, each once."""
        found = self.lookup(query)
        if mode == "any":
            # A word has one row for each document, so one word needs no distinct.
            return found.select(self.key) if len(query_terms(query, self.rule)) == 1 else found.select(self.key).distinct()
        counted = found.groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))
        return counted.filter(F.col("n") == len(query_terms(query, self.rule))).select(self.key)

    def matching(self, docs: DataFrame, query: str, mode: str = "any", content: str = "content") -> DataFrame:
        """Documents with the query's words, read by the stored keys.

        Unless the index is known to be current, the words are tested as well, which keeps out
        documents that have lost them since it was made.
        """
        found = fetch(docs, self.keys(query, mode), self.key)
        return found if self.current else found.filter(has_words(F.col(content), query, mode, self.rule))

    def stats(self, query: str) -> CorpusStats:
        """Two scalar subqueries: the corpus totals, and the documents per word."""
        terms = query_terms(query, self.rule)
        seen = self.lookup(query).agg(
            *[F.count_if(F.col("token") == t).alias(f"df{i}") for i, t in enumerate(terms)])
        return stats_from(self.corpus, seen, terms)

    def rank(self, query: str, limit: int = 0, mode: str = "any") -> DataFrame:
        """Keys and BM25 scores from the index alone; with a limit the best, ties by key, else all, unordered."""
        terms = query_terms(query, self.rule)
        stats = self.stats(query)
        per_doc = self.lookup(query).groupBy(self.key).agg(
            F.max("dl").alias("dl"), F.count(F.lit(1)).alias("held"),
            *[F.coalesce(F.max(F.when(F.col("token") == t, F.col("tf"))), F.lit(0)).alias(f"tf{i}")
              for i, t in enumerate(terms)])
        if mode == "all":
            per_doc = per_doc.filter(F.col("held") == len(terms))
        score = stats.combine(F.col("dl"), {t: F.col(f"tf{i}") for i, t in enumerate(terms)})
        scored = per_doc.select(self.key, score.alias("score"))
        if not limit:
            return scored
        ordered = scored.orderBy(F.desc("score"), F.asc(self.key))
        return ordered.limit(limit)
