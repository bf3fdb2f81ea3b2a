"""Where words stand: a stored table of positions, for phrases and words in order, without reading texts."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.functions.runs import in_parts, runs
from logsieve.functions.text import query_words, tokens
from logsieve.sources.tables import source_state
from logsieve.sources.versions import Versions

# Rows that a task sorts for one file.
ROWS_PER_FILE = 1_000_000
# Up to this distance, places that follow are listed and intersected; beyond it, they are compared.
LISTED = 64


def position_table(docs: DataFrame, content: str = "content", key: str = "doc_id") -> DataFrame:
    """Rows ``(token, key, at)``: a word, a document, the ascending places of the word there, from 0.

    A document is one row: its words are put in order with their places inside its batch of rows,
    and each run of equal words becomes a list. Nothing is shuffled.
    """
    kind = docs.schema[key].dataType.simpleString()
    words = docs.filter(F.col(content).isNotNull()).select(key, tokens(F.col(content)).alias("words"))

    def place(batches):
        for batch in batches:
            found = runs(batch.column("words"))
            at = pa.ListArray.from_arrays(pa.array(found.bounds, pa.int32()), pa.array(found.places, pa.int32()))
            yield from in_parts(pa.RecordBatch.from_arrays([found.token, batch.column(key).take(pa.array(found.doc)), at], names=["token", key, "at"]))

    return words.mapInArrow(place, f"token string, `{key}` {kind}, at array<int>")


def _shifted(places: Column, by: int) -> Column:
    return F.transform(places, lambda place: place + by)


def _after(following: Column, reached: Column, distance: int) -> Column:
    """The places that come after one that was reached, at most ``distance`` later; 0 is any distance."""
    if distance == 0:
        return F.filter(following, lambda place: place > F.array_min(reached))
    if distance <= LISTED:
        return F.array_intersect(following, F.flatten(F.array(*[_shifted(reached, by) for by in range(1, distance + 1)])))
    return F.filter(following, lambda place: F.exists(reached, lambda end: (place > end) & (place - end <= distance)))


@dataclass(frozen=True)
class PositionIndex:
    postings: DataFrame  # token, key, at; in ranges of (token, key)
    key: str = "doc_id"

    @staticmethod
    def ensure(docs: DataFrame, path: str, content: str = "content", key: str = "doc_id") -> "PositionIndex":
        """The newest version of the stored index if it was made from these documents as they are, else a new one."""
        spark, state = docs.sparkSession, f"{content}, {key}: {source_state(docs)}"

        def write(folder: str) -> None:
            position_table(docs, content, key).write.parquet(f"{folder}/unsorted")
            rows = spark.read.parquet(f"{folder}/unsorted")
            files = max(1, rows.count() // ROWS_PER_FILE)
            rows.repartitionByRange(files, "token", key).sortWithinPartitions("token", key).write.parquet(f"{folder}/postings")
            spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{folder}/unsorted")

        return PositionIndex.load(spark, Versions(spark, path).ensure(state, write), key)

    @staticmethod
    def load(spark: SparkSession, folder: str, key: str = "doc_id") -> "PositionIndex":
        return PositionIndex(spark.read.parquet(f"{folder}/postings"), key)

    def _places(self, words: list[str]) -> tuple[DataFrame, list[Column]]:
        """Documents with all the words, and the places of each word of the query."""
        distinct = list(dict.fromkeys(words))
        found = self.postings.filter(F.col("token").isin(distinct)).groupBy(self.key).agg(
            F.count(F.lit(1)).alias("held"),
            *[F.first(F.when(F.col("token") == w, F.col("at")), ignorenulls=True).alias(f"at{i}") for i, w in enumerate(distinct)])
        return found.filter(F.col("held") == len(distinct)), [F.col(f"at{distinct.index(w)}") for w in words]

    def phrase(self, query: str) -> DataFrame:
        """Rows ``(key, n)``: documents that hold the query's words next to each other in this order, and how often."""
        found, places = self._places(query_words(query))
        starts = places[0]
        for i, following in enumerate(places[1:], 1):
            starts = F.array_intersect(starts, _shifted(following, -i))
        return self._counted(found, starts)

    def in_order(self, query: str, distance: int = 0) -> DataFrame:
        """Rows ``(key, n)``: documents where the query's words follow each other in this order, others between them.

        Each is at most ``distance`` words after the one before, if that is given; ``n`` counts the
        places of the last word.
        """
        if distance < 0:
            raise ValueError("distance must not be negative")
        found, places = self._places(query_words(query))
        reached = places[0]
        for following in places[1:]:
            reached = _after(following, reached, distance)
        return self._counted(found, reached)

    def _counted(self, found: DataFrame, places: Column) -> DataFrame:
        return found.select(self.key, F.size(places).cast("long").alias("n")).filter(F.col("n") > 0)
