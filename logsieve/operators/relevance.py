"""BM25 relevance of text clauses (Robertson and Zaragoza, 2009)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.functions.text import SIMPLE, has_words, query_terms, term_frequency, tokens

# The usual BM25 parameters.
K1 = 1.2
B = 0.75


@dataclass(frozen=True)
class CorpusStats:
    """Document count, average length and document frequency per term, as Columns."""

    documents: Column
    average_length: Column
    frequency: dict[str, Column]

    def score(self, words: Column, terms: list[str]) -> Column:
        """BM25 of a token array for the given terms."""
        return self.combine(F.size(words), {t: term_frequency(words, t) for t in terms})

    def combine(self, length: Column, counts: dict[str, Column]) -> Column:
        """BM25 from a document length and the count of each term, added in term order."""
        total = F.lit(0.0)
        damping = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / self.average_length)
        for term, count in counts.items():
            total = total + self.idf(term) * count / (count + damping)
        return total

    def idf(self, term: str) -> Column:
        seen = self.frequency[term]
        return F.log(F.lit(1.0) + (self.documents - seen + F.lit(0.5)) / (seen + F.lit(0.5)))


def stats_from(corpus: DataFrame, seen: DataFrame, terms: list[str]) -> CorpusStats:
    """Statistics as scalar subqueries from the one-row ``(n, words)`` and ``(df0, df1, ...)``."""
    totals, counts = (row.select(F.struct("*")).scalar() for row in (corpus, seen))
    return CorpusStats(totals["n"], totals["words"] / totals["n"],
                       {term: counts[f"df{i}"] for i, term in enumerate(terms)})


def corpus_stats(docs: DataFrame, query: str, content: str = "content", rule: str = SIMPLE) -> CorpusStats:
    """Statistics of the documents for a query's terms: one pass, one row shuffled per task."""
    terms = query_terms(query, rule)
    words = docs.filter(F.col(content).isNotNull()).select(tokens(F.col(content), rule).alias("words"))
    row = words.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("words")).alias("words"),
        *[F.count_if(F.array_contains("words", t)).alias(f"df{i}") for i, t in enumerate(terms)])
    return stats_from(row, row, terms)


def rank(docs: DataFrame, query: str, limit: int = 0, mode: str = "any",
         content: str = "content", key: str = "doc_id") -> DataFrame:
    """Documents with the query's words and their BM25 score; with a limit the best, ties by key.

    Only hits are cut into words for scoring; the statistics still need one pass over all
    documents. A stored token table (``textindex``) saves that pass.
    """
    terms = query_terms(query)
    stats = corpus_stats(docs, query, content)
    found = (docs.filter(has_words(F.col(content), query, mode))
             .select(key, tokens(F.col(content)).alias("words")))
    scored = found.select(key, stats.score(F.col("words"), terms).alias("score"))
    return scored.orderBy(F.desc("score"), F.asc(key)).limit(limit) if limit else scored
