"""Documents as bits: boolean clauses and facets by word, answered without texts.

Documents are numbered; a bucket holds the bits of 32,768 numbers. For each word and bucket there is a bitmap of the
documents that have the word, and for each value of a facet likewise. A clause of words with and, or and not combines
bitmaps bucket by bucket; hits and facets are their cardinalities. Keys of hits come from the table of numbers.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.functions.text import query_terms, tokens
from logsieve.sources.tables import source_state
from logsieve.sources.versions import Versions

# What Spark's bitmap functions work with.
BITS, BYTES = 32_768, 4096
# Words of documents that a task sorts for one file.
ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class Words:
    """A word, or a combination of words: ``Words("a") & (Words("b") | ~Words("c"))``. Several words in one text are any of them."""

    kind: str
    parts: tuple

    def __init__(self, query: "str | Words", *more, kind: str = "or"):
        if isinstance(query, str):
            terms = query_terms(query)
            object.__setattr__(self, "kind", "word" if len(terms) == 1 else "or")
            object.__setattr__(self, "parts", tuple(terms) if len(terms) == 1 else tuple(Words(t) for t in terms))
        else:
            object.__setattr__(self, "kind", kind)
            object.__setattr__(self, "parts", (query, *more))

    def __and__(self, other: "Words") -> "Words":
        return Words(self, other, kind="and")

    def __or__(self, other: "Words") -> "Words":
        return Words(self, other, kind="or")

    def __invert__(self) -> "Words":
        return Words(self, kind="not")

    @property
    def words(self) -> set[str]:
        return set(self.parts) if self.kind == "word" else set().union(*(p.words for p in self.parts))

    def evaluate(self, bitmaps: dict[str, np.ndarray], every: np.ndarray) -> np.ndarray:
        if self.kind == "word":
            return bitmaps.get(self.parts[0], np.zeros_like(every))
        found = [p.evaluate(bitmaps, every) for p in self.parts]
        if self.kind == "not":
            return every & ~found[0]
        out = found[0]
        for part in found[1:]:
            out = out & part if self.kind == "and" else out | part
        return out


def _compress(batches):
    for batch in batches:
        made = pa.array([zlib.compress(b, 1) for b in batch.column("bits").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "bits"), made],
                                         names=[*(c for c in batch.schema.names if c != "bits"), "bits"])


def _bits(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8)


@dataclass(frozen=True)
class BitmapIndex:
    words: DataFrame    # token, bucket, bits; sorted
    facets: DataFrame   # path, value, bucket, bits
    every: DataFrame    # bucket, bits: documents that have content
    numbers: DataFrame  # bucket, bit, key
    key: str = "doc_id"

    @staticmethod
    def ensure(docs: DataFrame, path: str, facets: tuple[str, ...] = ("metadata.type",), content: str = "content", key: str = "doc_id") -> "BitmapIndex":
        """The newest version of the stored index if it was made from these documents as they are, else a new one."""
        spark, state = docs.sparkSession, f"{content}, {key}, {facets}: {source_state(docs)}"
        folder = Versions(spark, path).ensure(state, lambda folder: BitmapIndex.build(docs, folder, facets, content, key))
        return BitmapIndex.load(spark, folder, key)

    @staticmethod
    def build(docs: DataFrame, path: str, facets: tuple[str, ...], content: str, key: str) -> None:
        """Numbers follow the order in which documents are read; within a task they are without gaps."""
        spark = docs.sparkSession
        number = F.monotonically_increasing_id()
        own = docs.select(key, content, *[F.col(f).cast("string").alias(f"facet{i}") for i, f in enumerate(facets)], number.alias("number"))
        values = [f"facet{i}" for i in range(len(facets))]
        cut = own.select(key, "number", F.col(content).isNotNull().alias("present"), *values, F.array_distinct(tokens(F.col(content))).alias("w"))
        cut.write.parquet(f"{path}/cut")
        rows = spark.read.parquet(f"{path}/cut")
        place = (F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit"))
        rows.select(*place, key).repartitionByRange("bucket").sortWithinPartitions("bucket", "bit").write.parquet(f"{path}/numbers")

        def bitmaps(table: DataFrame, *by: str) -> DataFrame:
            built = table.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
            layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in built.schema.fields)
            return built.mapInArrow(_compress, layout)

        # Bits meet by word before they become a bitmap, so that 4 KB are held for one word at a time and never shuffled.
        bits = rows.select(F.explode("w").alias("token"), *place)
        files = max(1, (rows.agg(F.sum(F.greatest(F.size("w"), F.lit(0)))).first()[0] or 0) // ROWS_PER_FILE)
        ranges = bits.repartitionByRange(files, "token", "bucket").sortWithinPartitions("token", "bucket")
        bitmaps(ranges, "token").write.parquet(f"{path}/words")
        shown = [F.struct(F.lit(name).alias("path"), F.col(v).alias("value")) for name, v in zip(facets, values)]
        faceted = rows.select(F.inline(F.array(*shown)), *place) if shown else rows.select(F.lit("").alias("path"), F.lit("").alias("value"), *place).limit(0)
        bitmaps(faceted.filter(F.col("value").isNotNull()), "path", "value").write.parquet(f"{path}/facets")
        bitmaps(rows.filter("present").select(*place)).write.parquet(f"{path}/every")
        spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{path}/cut")

    @staticmethod
    def load(spark: SparkSession, path: str, key: str = "doc_id") -> "BitmapIndex":
        return BitmapIndex(*(spark.read.parquet(f"{path}/{name}") for name in ("words", "facets", "every", "numbers")), key)

    def _hits(self, clause: Words) -> DataFrame:
        """``bucket, bits`` of the documents for which the clause holds; a document without content is no hit."""
        words = self.words.filter(F.col("token").isin(sorted(clause.words)))
        rows = words.unionByName(self.every.select(F.lit("").alias("token"), "bucket", "bits"))
        # As many rows for a bucket as the clause has words.
        held = rows.groupBy("bucket").agg(F.collect_list(F.struct("token", "bits")).alias("held"))

        def evaluate(batches):
            for batch in batches:
                buckets, made = [], []
                for bucket, held in zip(batch.column("bucket").to_pylist(), batch.column("held").to_pylist()):
                    bitmaps = {h["token"]: _bits(h["bits"]) for h in held}
                    if "" in bitmaps:
                        found = clause.evaluate(bitmaps, bitmaps[""])
                        if found.any():
                            buckets.append(bucket)
                            made.append(found.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(made, pa.binary())], names=["bucket", "bits"])

        return held.mapInArrow(evaluate, "bucket long, bits binary")

    def count(self, clause: Words) -> DataFrame:
        """``hits``: how many documents."""
        return self._hits(clause).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("hits"))

    def keys(self, clause: Words) -> DataFrame:
        """Keys of the hits."""
        def places(batches):
            for batch in batches:
                bits = [np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8), bitorder="little")) for b in batch.column("bits").to_pylist()]
                n = [len(b) for b in bits]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("bucket").to_numpy(), n)), pa.array(
                    np.concatenate([*bits, np.zeros(0, np.int64)]).astype(np.int64))], names=["bucket", "bit"])

        return self.numbers.join(self._hits(clause).mapInArrow(places, "bucket long, bit long"), ["bucket", "bit"]).select(self.key)

    def facet(self, clause: Words, path: str) -> DataFrame:
        """``bucket, is_total, n`` as ``facets.facet`` gives them: hits per value, and all hits; no hits give no rows."""
        hits = self._hits(clause)
        values = self.facets.filter(F.col("path") == path).select("value", "bucket", F.col("bits").alias("own"))

        def both(batches):
            for batch in batches:
                n = [int(np.bitwise_count(_bits(a) & np.frombuffer(b, np.uint8)).sum()) for a, b in zip(batch.column("own").to_pylist(), batch.column("bits").to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(n, pa.int64())], names=["value", "n"])

        counts = values.join(hits, "bucket").select("value", "own", "bits").mapInArrow(both, "value string, n long")
        counts = counts.groupBy("value").agg(F.sum("n").alias("n")).filter("n > 0")
        total = self.count(clause).filter("hits > 0")
        return counts.select(F.col("value").alias("bucket"), F.lit(False).alias("is_total"), "n").unionByName(
            total.select(F.lit(None).cast("string").alias("bucket"), F.lit(True).alias("is_total"), F.col("hits").alias("n")))
