"""Log documents made from an events table: one document for each user and day, lines in time order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The level of each event type; any other type is INFO.
LEVELS = {"error": "ERROR", "purchase": "WARN"}
LOG = ["user_id", "d"]


def level(event_type: Column) -> Column:
    named = F.lit("INFO")
    for name, text in LEVELS.items():
        named = F.when(event_type == name, text).otherwise(named)
    return named


def log_line(events: DataFrame) -> DataFrame:
    """One rendered line per event: ``LEVEL yyyy-MM-dd HH:mm:ss user N {props}``."""
    line = F.concat_ws(" ", level(F.col("event_type")), F.substring(F.col("ts").cast("string"), 1, 19),
                       F.lit("user"), F.col("user_id").cast("string"), F.col("props"))
    return events.select("event_id", "ts", "user_id", F.to_date("ts").alias("d"), line.alias("line"))


def _named(logs: DataFrame) -> DataFrame:
    """Adds ``doc_id``, ``filename`` and ``metadata``; the type is the day."""
    name = F.concat_ws("_", F.col("user_id").cast("string"), F.col("d").cast("string"))
    return logs.withColumns({
        "doc_id": name, "filename": F.concat(name, F.lit(".log")),
        "metadata": F.struct(F.col("d").cast("string").alias("type"),
                             F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("server"))})


def log_documents(events: DataFrame, having: Callable[[Column], Column] | None = None) -> DataFrame:
    """One document per user and day.

    With ``having``, a test of one line, only documents with such a line: lines are tested where
    they are, and only those of documents with a hit are gathered.
    """
    lines = log_line(events)
    if having is not None:
        hits = lines.filter(having(F.col("line"))).select(*LOG).distinct()
        lines = lines.join(hits, LOG, "left_semi")
    grouped = lines.groupBy(*LOG).agg(
        F.array_sort(F.collect_list(F.struct("ts", "event_id", "line"))).alias("lines"))
    content = F.concat_ws("\n", F.col("lines.line")).alias("content")
    return _named(grouped).select("doc_id", "filename", content, "metadata")


def matching_log_lines(events: DataFrame, having: Callable[[Column], Column], count: Callable[[Column], Column]) -> DataFrame:
    """``doc_id, filename, metadata, lines, n`` of the documents with a line that passes.

    Only those lines are gathered, in time order; ``n`` is the sum of a count over them. Documents
    are never put together, so a user with most of the events costs no more than their hits.
    """
    found = log_line(events).filter(having(F.col("line")))
    grouped = found.groupBy(*LOG).agg(
        F.array_sort(F.collect_list(F.struct("ts", "event_id", "line"))).alias("found"),
        F.sum(count(F.col("line"))).alias("n"))
    return _named(grouped).select("doc_id", "filename", "metadata", F.col("found.line").alias("lines"), "n")
