"""Searching a stream of documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from logsieve.operators.clauses import Clause
from logsieve.operators.search import search


def search_stream(docs: DataFrame, clause: Clause, columns: Sequence[str | Column] = ("doc_id",)) -> DataFrame:
    """Hits of a streaming DataFrame: the same filter as on a table, without state.

    Counts, limits and corpus statistics need all rows, so they belong to stored tables.
    """
    if not docs.isStreaming:
        raise ValueError("not a streaming DataFrame; use search")
    return search(docs, clause, columns)
