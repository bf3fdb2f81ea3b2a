"""The best documents by relevance without scoring every posting: block maxima.

Documents are dealt into blocks of neighbouring keys. Postings are stored by word and block, and for each word and block
the largest share that a document there can add to a score. For a query, the shares of a block's words, weighted, bound
the score of any document in it. The blocks with the highest bounds, as many as documents are wanted, are scored first:
each has a document with one of the words, so the score of the last of the best is a threshold. Only blocks whose bound
reaches it are scored then. The result is that of scoring everything, ties included.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.functions.text import query_terms
from logsieve.operators.relevance import K1, B
from logsieve.operators.textindex import DOCUMENT, token_table
from logsieve.sources.tables import source_state
from logsieve.sources.versions import Versions

# Documents of a block, rows of a file, blocks that are named to a scan.
BLOCK_DOCS, ROWS_PER_FILE, MOST_NAMED = 128, 1_000_000, 5000
# Bounds are sums in another order than scores: this much is allowed for rounding.
_SLACK = 1 + 1e-9


@dataclass(frozen=True)
class BlockIndex:
    postings: DataFrame  # token, block, key, tf, dl; in ranges of (token, block, key)
    blocks: DataFrame    # token, block, share, docs
    corpus: DataFrame    # n, words
    key: str = "doc_id"

    @staticmethod
    def ensure(docs: DataFrame, path: str, content: str = "content", key: str = "doc_id", block_docs: int = BLOCK_DOCS) -> "BlockIndex":
        """The newest version of the stored index if it was made from these documents as they are, else a new one."""
        spark, state = docs.sparkSession, f"{content}, {key}, {block_docs}: {source_state(docs)}"
        folder = Versions(spark, path).ensure(state, lambda folder: BlockIndex.build(docs, folder, content, key, block_docs))
        return BlockIndex.load(spark, folder, key)

    @staticmethod
    def build(docs: DataFrame, path: str, content: str = "content", key: str = "doc_id", block_docs: int = BLOCK_DOCS) -> None:
        spark = docs.sparkSession
        token_table(docs, content, key, mark_documents=True).write.parquet(f"{path}/unsorted")
        rows = spark.read.parquet(f"{path}/unsorted")
        marks = rows.filter(F.col("token") == DOCUMENT)
        marks.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("words")).coalesce(1).write.parquet(f"{path}/corpus")
        totals = spark.read.parquet(f"{path}/corpus").first()
        # A document's block follows from its key alone: a range of numbers, a prefix of a hash for other keys.
        blocks = max(1, totals["n"] // block_docs)
        if docs.schema[key].dataType.simpleString() in ("bigint", "int"):
            low, high = (x or 0 for x in marks.agg(F.min(key), F.max(key)).first())
            block = F.floor((F.col(key).cast("decimal(38,0)") - F.lit(low)) * blocks / F.lit(high - low + 1).cast("decimal(38,0)")).cast("long")
        else:
            block = F.pmod(F.xxhash64(key), F.lit(blocks))
        dealt = rows.filter(F.col("token") != DOCUMENT).withColumn("block", F.coalesce(block, F.lit(-1).cast("long")))
        files = max(1, rows.count() // ROWS_PER_FILE)
        (dealt.select("token", "block", key, "tf", "dl").repartitionByRange(files, "token", "block", key)
         .sortWithinPartitions("token", "block", key).write.parquet(f"{path}/postings"))
        spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{path}/unsorted")
        average = max(1.0, totals["words"]) / max(1, totals["n"])
        share = F.col("tf") / (F.col("tf") + _damping(F.col("dl"), F.lit(average)))
        # Put into as many ranges as the postings, so that a task's groups stay as few however many there are in all.
        shares = spark.read.parquet(f"{path}/postings").select("token", "block", share.alias("share")).repartitionByRange(files, "token", "block")
        found = shares.groupBy("token", "block").agg(F.max("share").alias("share"), F.count(F.lit(1)).alias("docs"))
        found.sortWithinPartitions("token", "block").write.parquet(f"{path}/blocks")

    @staticmethod
    def load(spark: SparkSession, path: str, key: str = "doc_id") -> "BlockIndex":
        return BlockIndex(*(spark.read.parquet(f"{path}/{name}") for name in ("postings", "blocks", "corpus")), key)

    def _weights(self, terms: list[str]) -> tuple[dict[str, float], float]:
        """Weight of each word and the average length, from the table of blocks: one row for each word."""
        totals = self.corpus.first()
        seen = {r.token: r.df for r in self.blocks.filter(F.col("token").isin(terms)).groupBy("token").agg(F.sum("docs").alias("df")).collect()}
        n = F.lit(float(totals["n"]))
        idf = self.corpus.select(*[F.log(F.lit(1.0) + (n - F.lit(float(seen.get(t, 0))) + 0.5) / (F.lit(float(seen.get(t, 0))) + 0.5)).alias(f"w{i}")
                                   for i, t in enumerate(terms)]).first()
        return {t: idf[i] for i, t in enumerate(terms)}, totals["words"] / totals["n"] if totals["n"] else 1.0

    def _bounds(self, weights: dict[str, float]) -> DataFrame:
        """``block, bound, docs``: no document of a block scores more than its bound."""
        weight = _by_word(weights)
        rows = self.blocks.filter(F.col("token").isin(list(weights)))
        return rows.groupBy("block").agg(F.sum(weight * F.col("share")).alias("bound"), F.sum("docs").alias("postings"))

    def _scores(self, weights: dict[str, float], average: float, blocks: list[int] | DataFrame) -> DataFrame:
        """``key, score`` of the documents in some blocks, added up in the order of the words."""
        rows = self.postings.filter(F.col("token").isin(list(weights)))
        rows = rows.filter(F.col("block").isin(blocks)) if isinstance(blocks, list) else rows.join(blocks.select("block"), "block", "left_semi")
        per_doc = rows.groupBy(self.key).agg(F.max("dl").alias("dl"), *[
            F.coalesce(F.max(F.when(F.col("token") == t, F.col("tf"))), F.lit(0)).alias(f"tf{i}") for i, t in enumerate(weights)])
        damping, total = _damping(F.col("dl"), F.lit(average)), F.lit(0.0)
        for i, weight in enumerate(weights.values()):
            total = total + F.lit(weight) * F.col(f"tf{i}") / (F.col(f"tf{i}") + damping)
        return per_doc.select(self.key, total.alias("score"))

    def _surviving(self, query: str, limit: int) -> tuple[DataFrame, dict[str, float], float]:
        """Blocks that can hold one of the best documents."""
        if limit < 1:
            raise ValueError("limit must be at least 1")
        weights, average = self._weights(query_terms(query))
        bounds = self._bounds(weights)
        # As many blocks as documents are wanted: a bounded number of rows.
        first = [r.block for r in bounds.orderBy(F.desc("bound"), "block").limit(limit).collect()]
        found = self._scores(weights, average, first).orderBy(F.desc("score")).limit(limit).agg(
            F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).first()
        least = found["least"] if found["n"] == limit else None
        return (bounds if least is None else bounds.filter(F.col("bound") * _SLACK >= least)), weights, average

    def rank(self, query: str, limit: int) -> DataFrame:
        """Keys and BM25 scores of the best documents with any of the words, ties by key."""
        surviving, weights, average = self._surviving(query, limit)
        named = [r.block for r in surviving.select("block").limit(MOST_NAMED + 1).collect()]
        scored = self._scores(weights, average, named if len(named) <= MOST_NAMED else surviving)
        return scored.orderBy(F.desc("score"), F.asc(self.key)).limit(limit)

    def read(self, query: str, limit: int) -> DataFrame:
        """``blocks, scored, postings, scored_postings``: how much of the words' blocks and postings ``rank`` scores."""
        surviving, weights, _ = self._surviving(query, limit)
        kept = surviving.agg(F.count(F.lit(1)).alias("scored"), F.coalesce(F.sum("postings"), F.lit(0)).alias("scored_postings"))
        every = self._bounds(weights).agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("postings"), F.lit(0)).alias("postings"))
        both = kept.select(F.struct("*")).scalar()
        return every.select("blocks", both["scored"].alias("scored"), "postings", both["scored_postings"].alias("scored_postings"))


def _damping(length: Column, average: Column) -> Column:
    return F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / average)


def _by_word(weights: dict[str, float]) -> Column:
    found = F.lit(0.0)
    for word, weight in weights.items():
        found = F.when(F.col("token") == word, F.lit(weight)).otherwise(found)
    return found
