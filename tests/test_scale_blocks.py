"""Block maxima: what a task sorts and groups stays as much, however many blocks there are."""

from pyspark.sql import functions as F

from logsieve.operators import blockmax
from logsieve.operators.blockmax import BlockIndex
from logsieve.operators.relevance import rank


def test_blocks_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    assert blockmax.ROWS_PER_FILE <= 1_000_000
    monkeypatch.setattr(blockmax, "ROWS_PER_FILE", 300)
    words = F.concat_ws(" ", F.lit("all"), *[F.concat(F.lit(f"w{j}x"), F.pmod(F.xxhash64("id", F.lit(j)), F.lit(40)).cast("string")) for j in range(4)])
    spark.range(800).select(F.col("id").alias("doc_id"), words.alias("content")).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    index = BlockIndex.ensure(docs, str(tmp_path / "b"), block_docs=8)
    # 4000 postings and nearly as many blocks: files of both hold about as many rows.
    assert len(index.postings.inputFiles()) >= 10 and len(index.blocks.inputFiles()) >= 10
    assert index.blocks.groupBy("token", "block").count().filter("count > 1").count() == 0
    best = [(r.doc_id, round(r.score, 9)) for r in index.rank("all w1x7", 9).collect()]
    assert best == [(r.doc_id, round(r.score, 9)) for r in rank(docs, "all w1x7", 9).collect()]
