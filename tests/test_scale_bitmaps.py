"""Bitmaps: bits are sorted and sent, not bitmaps of 4 KB, and what a task sorts is bounded by words of documents."""

from pyspark.sql import functions as F

from logsieve.operators import bitmaps
from logsieve.operators.bitmaps import BitmapIndex, Words


def test_words_are_dealt_by_their_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bitmaps, "ROWS_PER_FILE", 200)
    words = F.concat_ws(" ", F.lit("all"), F.concat(F.lit("w"), (F.col("id") % 50).cast("string")))
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 9 > 0, words).alias("content"),
                                    F.struct((F.col("id") % 3).cast("string").alias("type")).alias("metadata"))
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    index = BitmapIndex.ensure(docs, str(tmp_path / "b"))
    assert len(index.words.inputFiles()) > 4
    assert index.words.groupBy("token", "bucket").count().filter("count > 1").count() == 0
    assert index.count(Words("all")).first().hits == sum(i % 9 > 0 for i in range(1000))
    assert {r.doc_id for r in index.keys(Words("w7")).collect()} == {i for i in range(1000) if i % 9 and i % 50 == 7}
    none = BitmapIndex.ensure(docs.filter("content is null"), str(tmp_path / "n"))
    assert none.count(Words("all")).first().hits == 0
