"""Searching a documents DataFrame with a clause."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.operators.clauses import Clause


def hits(docs: DataFrame, clause: Clause) -> DataFrame:
    """The matching rows, unscored. A plain filter, so it reaches the scan."""
    return docs.filter(clause.holds)


def search(docs: DataFrame, clause: Clause, columns: Sequence[str | Column] = ("doc_id",),
           limit: int = 0, score: bool = False) -> DataFrame:
    """Matching rows with the chosen columns and, on request, a ``score`` column.

    A limit without order stops reading as soon as enough rows are found; use ``top`` for a
    fixed choice. ``limit=0`` returns every hit.
    """
    found = hits(docs, clause)
    chosen = [F.col(c) if isinstance(c, str) else c for c in columns]
    if score:
        chosen.append(clause.score.alias("score"))
    return capped(found.select(*chosen), limit)


def top(docs: DataFrame, clause: Clause, limit: int, columns: Sequence[str | Column] = (),
        key: str = "doc_id") -> DataFrame:
    """The ``limit`` best hits by score, ties by key. Each task keeps only its own best rows."""
    chosen = [F.col(c) if isinstance(c, str) else c for c in columns if c != key]
    scored = hits(docs, clause).select(F.col(key), *chosen, clause.score.alias("score"))
    return scored.orderBy(F.desc("score"), F.asc(key)).limit(limit)


def first(docs: DataFrame, clause: Clause, limit: int, columns: Sequence[str | Column] = (),
          key: str = "doc_id") -> DataFrame:
    """The ``limit`` hits with the smallest keys; without a limit all hits, unordered."""
    chosen = [F.col(c) if isinstance(c, str) else c for c in columns if c != key]
    found = hits(docs, clause).select(F.col(key), *chosen)
    return found.orderBy(F.asc(key)).limit(limit) if limit else found


def capped(rows: DataFrame, limit: int) -> DataFrame:
    return rows.limit(limit) if limit else rows


def resolve_limit(override: int | None, default: int) -> int:
    """A query's own limit, or the default when it has none. 0 means all hits."""
    return default if override is None else override


def count_hits(docs: DataFrame, clause: Clause) -> DataFrame:
    """Number of hits, counted where the data is."""
    return hits(docs, clause).agg(F.count(F.lit(1)).alias("hits"))
