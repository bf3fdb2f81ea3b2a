"""Queries on the test tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.sources.documents import prose
from logsieve.sources.logs import log_documents
from logsieve.sources.tables import ensure_table, library_path, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """The test tables, and documents derived from them."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def prose(self) -> DataFrame:
        return prose(self.documents)

    def assembled(self) -> DataFrame:
        """Log documents, put together from the events."""
        return log_documents(self.events)

    def logs(self) -> DataFrame:
        """The same documents, put together once and then scanned like any table."""
        return self.loaded("logs", self.assembled)

    def rated(self) -> DataFrame:
        """The documents with their label's quality as text; a document without a label has none."""
        labels = self.labels.select("doc_id", F.col("quality").cast("string").alias("rating"))
        return self.prose().join(labels, "doc_id", "left")

    def loaded(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = hashlib.sha256(self.folder.encode()).hexdigest()
        return ensure_table(self.spark, library_path(self.spark, f"{name}-{key}"), build, sorted_by="doc_id")


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


# The same derivations in SQL.

WORDS = r"'[\p{L}\p{M}\p{N}_]+'"

PROSE = """prose AS (SELECT doc_id, source || '/' || doc_id || '.txt' AS filename, text AS content,
  lang AS type, source AS server FROM documents)"""

# A log is what one user did on one day, a line per event, in time order.
LOGS = """log_lines AS (SELECT event_id, ts, user_id, CAST(ts AS DATE) AS d,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' ELSE 'INFO' END || ' ' ||
  strftime(ts, '%Y-%m-%d %H:%M:%S') || ' user ' || user_id || ' ' || props AS line FROM events),
logs AS (SELECT user_id || '_' || d AS doc_id, user_id || '_' || d || '.log' AS filename,
  string_agg(line, chr(10) ORDER BY ts, event_id) AS content, CAST(d AS VARCHAR) AS type, 'user-' || user_id AS server
  FROM log_lines GROUP BY user_id, d)"""

RATED = """rated AS (SELECT d.doc_id, d.text AS content, CAST(l.quality AS VARCHAR) AS rating
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def tokens_sql(value: str = "content") -> str:
    return f"regexp_extract_all(lower({value}), {WORDS})"
