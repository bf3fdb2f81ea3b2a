"""The vector index: what is sent grows with slices of the vectors, not with queries times lists; samples pass the driver once."""

import numpy as np
from pyspark.sql import functions as F

from logsieve.operators import vectorindex
from logsieve.operators.nearest import nearest_batch
from logsieve.operators.vectorindex import VectorIndex


def stored(spark, path, n=600, width=8):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=width))]) for i in range(n)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{path}/rows")
    return spark.read.parquet(f"{path}/rows")


def test_a_query_is_sent_once_to_each_slice(spark, tmp_path, monkeypatch):
    vectors = stored(spark, tmp_path)
    index = VectorIndex.ensure(vectors, f"{tmp_path}/index")
    asked = vectors.filter("vec_id % 20 = 0")
    shard, cuts = index._shards(250)
    assert len(index.quantiser.centres) == 24 and 3 <= shard.max() + 1 <= 6 and all(s == 1 for _, _, s in cuts)
    rows = index._reachable(asked, 5, shard)
    assert rows.count() <= 30 * (shard.max() + 1) < rows.agg(F.sum(F.size("lists"))).first()[0]
    # Also where a list is cut into slices and queries into blocks.
    expected = {(r.query_id, r["rank"], r.vec_id) for r in nearest_batch(vectors, asked, 5).collect()}
    for most in (SMALL := 8 * 10, 8 * 250):
        monkeypatch.setattr(vectorindex, "SLICE_NUMBERS", most)
        monkeypatch.setattr(vectorindex, "CODE_SLICE", most // 8)
        monkeypatch.setattr(vectorindex, "BLOCK", 7 if most == SMALL else 1024)
        assert {(r.query_id, r["rank"], r.vec_id) for r in index.search_exact(asked, 5).collect()} == expected
        found = {(r.query_id, r.vec_id) for r in index.search(asked, 5, probes=24, candidates=600).collect()}
        assert found == {(q, v) for q, _, v in expected}


def test_the_sample_is_stored_before_it_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vectorindex, "SAMPLE", 100)
    vectors = stored(spark, tmp_path)
    VectorIndex.build(vectors, f"{tmp_path}/index")
    kept = [r.vector for r in spark.read.parquet(f"{tmp_path}/index/sample").orderBy(F.xxhash64("vector"), "vector").collect()]
    assert kept == [r.embedding for r in vectors.orderBy(F.xxhash64("embedding"), "embedding").limit(100).collect()]
