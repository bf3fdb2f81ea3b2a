"""A stored table of trigrams, and pattern search on it.

A pattern becomes a formula of trigrams that every match must hold (``functions/grams``). Documents that satisfy it are
found in the table, and only these are read and tested with the pattern itself: the hits are those of a full scan. A
pattern that needs no trigram, or only such as a large part of the documents have, is a scan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.functions.grams import TRUE, All, Any, Gram, all_of, any_of, grams_in, required_grams
from logsieve.functions.patterns import FIND, WHOLE, Pattern, compile_pattern
from logsieve.functions.runs import in_parts
from logsieve.operators.fetch import fetch
from logsieve.sources.tables import source_state
from logsieve.sources.versions import Versions

# Characters of a text that are cut into trigrams at once, rows of a file, trigrams of one text that are looked up, and
# the part of the documents above which the table isn't asked.
PIECE, ROWS_PER_FILE, ASKED, MOST_SHARE = 50_000, 2_000_000, 6, 0.3


def trigram_table(docs: DataFrame, content: str = "content", key: str = "doc_id") -> DataFrame:
    """Rows ``(gram, key)``: the ASCII trigrams of the lower-cased texts, each once for a piece of a text.

    Long texts are cut into pieces that overlap by two characters. Nothing is shuffled.
    """
    texts = docs.filter(F.col(content).isNotNull()).select(key, F.lower(content).alias("text"))
    pieces = F.greatest(F.ceil((F.length("text") - 2) / PIECE), F.lit(1))
    cut = texts.select(key, F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), pieces - 1), lambda i: F.substring(
        F.col("text"), (i * PIECE + 1).cast("int"), F.lit(PIECE + 2)))).alias("piece"))
    kind = docs.schema[key].dataType.simpleString()

    def grams(batches):
        for batch in batches:
            found = [_codes(piece.as_buffer()) for piece in batch.column("piece")]
            code = np.concatenate([*found, np.zeros(0, np.int32)]).astype(np.int32)
            every, place = np.unique(code, return_inverse=True)
            texts = pa.array([bytes((c >> 14, c >> 7 & 127, c & 127)).decode() for c in every.tolist()], pa.string())
            of = np.repeat(np.arange(batch.num_rows), [len(f) for f in found])
            yield from in_parts(pa.RecordBatch.from_arrays([texts.take(pa.array(place)), batch.column(key).take(pa.array(of))], names=["gram", key]))

    return cut.mapInArrow(grams, f"gram string, `{key}` {kind}")


def _codes(text: pa.Buffer) -> np.ndarray:
    """The distinct places where three ASCII characters begin, which are bytes of their own, as numbers of 21 bits."""
    own = np.frombuffer(text, np.uint8)
    ascii_ = own < 128
    here = np.flatnonzero(ascii_[:-2] & ascii_[1:-1] & ascii_[2:])
    own = own.astype(np.int32)
    return np.unique(own[here] << 14 | own[here + 1] << 7 | own[here + 2])


def rarest(formula, seen: dict[str, int], asked: int = ASKED):
    """The formula with only the rarest trigrams of each conjunction: it asks less, and so refuses no more."""
    if isinstance(formula, Gram):
        return formula
    if isinstance(formula, Any):
        return any_of(*(rarest(part, seen, asked) for part in formula.parts))
    own = sorted((p for p in formula.parts if isinstance(p, Gram)), key=lambda g: (seen.get(g.text, 0), g.text))
    return all_of(*own[:asked], *(rarest(p, seen, asked) for p in formula.parts if not isinstance(p, Gram)))


def at_most(formula, seen: dict[str, int]) -> int:
    """How many documents can satisfy the formula, from the number that each trigram has."""
    if isinstance(formula, Gram):
        return seen.get(formula.text, 0)
    counts = [at_most(part, seen) for part in formula.parts]
    return min(counts) if isinstance(formula, All) else sum(counts)


def satisfied(formula, held: Column) -> Column:
    """Whether an array of trigrams satisfies the formula."""
    if isinstance(formula, Gram):
        return F.array_contains(held, formula.text)
    own = [p.text for p in formula.parts if isinstance(p, Gram)]
    rest = [satisfied(p, held) for p in formula.parts if not isinstance(p, Gram)]
    if own:
        texts = F.array(*map(F.lit, sorted(own)))
        rest.append(F.arrays_overlap(held, texts) if isinstance(formula, Any) else F.size(F.array_intersect(held, texts)) == len(own))
    found = rest[0]
    for test in rest[1:]:
        found = found | test if isinstance(formula, Any) else found & test
    return found


@dataclass(frozen=True)
class TrigramIndex:
    postings: DataFrame    # gram, key; in ranges of both
    seen: DataFrame        # gram, n
    documents: int
    content: str = "content"
    key: str = "doc_id"

    @staticmethod
    def ensure(docs: DataFrame, path: str, content: str = "content", key: str = "doc_id") -> "TrigramIndex":
        """The newest version of the stored index if it was made from these documents as they are, else a new one."""
        spark, state = docs.sparkSession, f"{content}, {key}: {source_state(docs)}"
        folder = Versions(spark, path).ensure(state, lambda folder: TrigramIndex.build(docs, folder, content, key))
        return TrigramIndex.load(spark, folder, content, key)

    @staticmethod
    def build(docs: DataFrame, path: str, content: str = "content", key: str = "doc_id") -> None:
        """Texts are cut once; the rows are then put into ranges of (gram, key), a common trigram into many files."""
        spark = docs.sparkSession
        trigram_table(docs, content, key).write.mode("overwrite").parquet(f"{path}/unsorted")
        rows = spark.read.parquet(f"{path}/unsorted")
        files = max(1, rows.count() // ROWS_PER_FILE)
        rows.repartitionByRange(files, "gram", key).sortWithinPartitions("gram", key).write.mode("overwrite").parquet(f"{path}/postings")
        spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{path}/unsorted")
        counts = spark.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        counts.repartitionByRange(max(1, files // 64), "gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/seen")
        docs.agg(F.count(F.lit(1)).alias("documents")).coalesce(1).write.mode("overwrite").parquet(f"{path}/corpus")

    @staticmethod
    def load(spark: SparkSession, path: str, content: str = "content", key: str = "doc_id") -> "TrigramIndex":
        documents = spark.read.parquet(f"{path}/corpus").first()["documents"]
        return TrigramIndex(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/seen"), documents, content, key)

    def plan(self, pattern: Pattern) -> tuple[object, int]:
        """The formula to ask the table and how many documents satisfy it at most; TRUE means a scan."""
        formula = required_grams(pattern)
        if formula == TRUE:
            return TRUE, self.documents
        # The trigrams of one pattern: a few rows.
        seen = {r.gram: r.n for r in self.seen.filter(F.col("gram").isin(sorted(grams_in(formula)))).collect()}
        formula = rarest(formula, seen)
        most = at_most(formula, seen)
        return (formula, most) if most <= MOST_SHARE * self.documents else (TRUE, self.documents)

    def candidates(self, pattern: Pattern) -> DataFrame | None:
        """Keys of the documents that can match, each once; None where all can."""
        formula, _ = self.plan(pattern)
        if formula == TRUE:
            return None
        found = self.postings.filter(F.col("gram").isin(sorted(grams_in(formula))))
        held = found.groupBy(self.key).agg(F.collect_set("gram").alias("held"))
        return held.filter(satisfied(formula, F.col("held"))).select(self.key)

    def _matching(self, docs: DataFrame, pattern: Pattern, value: Column) -> DataFrame:
        keys = self.candidates(pattern)
        rows = docs if keys is None else fetch(docs, keys, self.key)
        return rows.filter(pattern.test(value))

    def find(self, docs: DataFrame, pattern: str | Pattern, options: str = "") -> DataFrame:
        """The rows that ``clauses.find`` keeps."""
        return self._matching(docs, compile_pattern(pattern, FIND, options), F.col(self.content))

    def regex(self, docs: DataFrame, pattern: str | Pattern, on: str = "value") -> DataFrame:
        """The rows that ``clauses.regex`` keeps, on the value or its lower-cased form."""
        if on not in ("value", "lower"):
            raise ValueError(f"on must be 'value' or 'lower', not {on!r}")
        value = F.col(self.content)
        return self._matching(docs, compile_pattern(pattern, WHOLE), F.lower(value) if on == "lower" else value)

