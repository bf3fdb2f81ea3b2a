import math
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from logsieve.operators import report
from logsieve.operators.clauses import compound, find, regex, text
from logsieve.operators.facets import facet
from logsieve.operators.fetch import fetch
from logsieve.operators.nearest import nearest, nearest_batch
from logsieve.operators.parity import compare_keys, difference, parity
from logsieve.operators.relevance import rank
from logsieve.operators.search import count_hits, first, resolve_limit, search
from logsieve.operators.textindex import TokenIndex
from logsieve.sources import tables
from logsieve.sources.documents import DOCUMENTS, OPEN_METADATA, prose, read_json_documents
from logsieve.sources.logs import log_documents, matching_log_lines
from logsieve.sources.versions import Versions
from logsieve.streaming import search_stream

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return prose(tables.read_table(spark, DATA, "documents")).cache()


@pytest.fixture(scope="module")
def logs(spark):
    return log_documents(tables.read_table(spark, DATA, "events")).cache()


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "words")
    TokenIndex.of(docs).save(path)
    return TokenIndex.load(spark, path)


def keys(rows, key="doc_id"):
    return sorted(r[key] for r in rows.select(key).collect())


# ---- logs

def one_user(spark, n):
    kind = F.when(F.col("id") % 100 == 0, "error").otherwise("click")
    return spark.range(n).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"),
        F.lit(7).cast("long").alias("user_id"), kind.alias("event_type"), F.lit("{}").alias("props"))


def test_a_log_is_one_user_on_one_day(spark):
    rows = log_documents(one_user(spark, 10_000)).collect()
    assert len(rows) == 1 and rows[0]["doc_id"] == "7_2024-01-01" and rows[0]["content"].count("\n") == 9_999


def test_hits_of_a_hot_user_need_no_document(spark):
    found = matching_log_lines(one_user(spark, 10_000), lambda x: x.contains("ERROR"), lambda x: F.lit(1))
    assert found.first()["n"] == 100 and len(found.first()["lines"]) == 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Contains" in plan.split("collect_list")[-1]


def test_only_documents_with_a_hit_are_put_together(spark, logs):
    some = log_documents(tables.read_table(spark, DATA, "events"), lambda x: x.contains("ERROR"))
    assert sorted(some.collect(), key=lambda r: r["doc_id"]) == sorted(
        search(logs, find("content", "ERROR"), logs.columns).collect(), key=lambda r: r["doc_id"])


# ---- index

def test_index_equals_direct_search(docs, index):
    for query, mode in (("license gnu", "any"), ("license gnu", "all"), ("the", "any"), ("nosuchword", "any")):
        direct = keys(search(docs, text("content", query, mode)))
        assert keys(index.matching(docs, query, mode)) == direct
        assert keys(index.keys(query, mode)) == direct


def test_index_scores_equal_direct_scores(docs, index):
    for limit in (0, 5):
        direct = [(r[0], round(r[1], 9)) for r in rank(docs, "license the, software", limit).collect()]
        stored = [(r[0], round(r[1], 9)) for r in index.rank("license the, software", limit).collect()]
        assert (direct == stored if limit else sorted(direct) == sorted(stored)) and len(direct) > 3


def test_documents_that_have_changed_since(spark, docs, index, tmp_path):
    changed = docs.withColumn("content", F.when(F.col("doc_id") % 2 == 0, "nothing left").otherwise(F.col("content")))
    expected = keys(search(changed, text("content", "the")))
    assert keys(index.matching(changed, "the")) == expected and len(expected) > 50
    path, source = str(tmp_path / "i"), str(tmp_path / "docs")
    docs.select("doc_id", "content").write.parquet(source)
    first_time = TokenIndex.ensure(spark.read.parquet(source), path).postings.count()
    changed.select("doc_id", "content").write.mode("overwrite").parquet(source)
    again = TokenIndex.ensure(spark.read.parquet(source), path)
    assert again.postings.count() < first_time and keys(again.keys("nothing")) == [k for k in keys(docs) if k % 2 == 0]


def test_index_lookup_reaches_the_scan(index, docs):
    plan = index.lookup("license gnu")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(token" in plan
    common = fetch(docs, index.keys("the"), most=5)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in common


def test_few_keys_are_read_by_ranges(spark, tmp_path):
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.format_string("%06d", "id").alias("name"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 40).alias("content"))
    rows.write.parquet(str(tmp_path / "source"))
    table = tables.ensure_table(spark, str(tmp_path / "t"), lambda: spark.read.parquet(str(tmp_path / "source")), sorted_by="doc_id")
    wanted = [3, 4, 5, 900, 29_999, 12_345]
    some = spark.createDataFrame([(i,) for i in [*wanted, 70_000, None]], "doc_id long")
    found = fetch(table, some)
    assert keys(found) == sorted(wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(doc_id,5)" in plan and "Join" not in plan
    names = table.filter(F.col("doc_id").isin(wanted)).select("name")
    assert keys(fetch(table, names, "name")) == sorted(wanted)
    assert fetch(table, some.limit(0)).count() == 0 and keys(fetch(table, some, most=2)) == sorted(wanted)
    every = spark.range(0, 30_000, 20).select(F.col("id").alias("doc_id"))
    assert fetch(table, every).count() == 1500


def test_a_word_in_every_document_is_spread_over_files(spark, tmp_path):
    same = spark.range(0, 20_000, 1, 4).select(F.col("id").alias("doc_id"), F.lit("same").alias("content"))
    TokenIndex.of(same).save(str(tmp_path / "i"), rows_per_file=5_000)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "i" / "postings"))
             .groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 20_000 / 2


# ---- facets, parity, limits

def test_a_filter_reaches_the_scan_and_prunes_columns(spark):
    stored = tables.read_table(spark, DATA, "documents").withColumnRenamed("text", "content")
    rows = search(stored, find("content", "license"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(text,license)" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    both = compound(filter=[find("content", "license")], must=[regex("content", "(.*)GNU(.*)")],
                    must_not=[find("content", "zzz")])
    plan = search(stored, both)._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(text,license)" in plan and "StringContains(text,GNU)" in plan


def test_facet_without_values(logs):
    rows = facet(logs.withColumn("t", F.lit(None).cast("string")), find("content", "ERROR"), "t").collect()
    assert [(r["bucket"], r["is_total"]) for r in rows] == [(None, True)]


def test_parts_add_up(docs):
    found = count_hits(docs, find("content", "license")).first()["hits"]
    rest = count_hits(docs, compound(must_not=[find("content", "license")])).first()["hits"]
    assert found + rest == docs.count()
    plain, both = find("content", "[Ll]icense"), compound(filter=[text("content", "license")], must=[find("content", "[Ll]icense")])
    assert parity(docs, plain, {"compound": both}).first()["only_strategy"] == 0


def test_key_sets(spark):
    left = spark.createDataFrame([(1,), (2,), (2,)], "doc_id long")
    right = spark.createDataFrame([(2,), (3,)], "doc_id long")
    assert sorted((r[0], r[1]) for r in compare_keys(left, right).collect()) == [(1, "left"), (3, "right")]
    assert keys(difference(left, right)) == [1, 2]


def test_limits(logs):
    assert search(logs, find("content", "ERROR"), limit=20).count() == 20
    assert keys(first(logs, find("content", "WARN"), 2)) == keys(search(logs, find("content", "WARN")))[:2]
    assert "Sort" not in first(logs, find("content", "WARN"), 0)._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
    assert (resolve_limit(None, 20), resolve_limit(0, 20), resolve_limit(5, 20)) == (20, 0, 5)


# ---- vectors

@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_nearest_equals_brute_force(spark, metric):
    rows = [(i, [math.sin(i * (j + 1)) for j in range(5)]) for i in range(60)] + [(60, [0.0] * 5), (61, [1.0] * 4), (62, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    query = [0.3, -0.2, 0.9, 0.1, 0.5]

    def score(v):
        dot = sum(a * b for a, b in zip(v, query))
        if metric == "dot":
            return dot
        if metric == "euclidean":
            return -math.dist(v, query)
        size = math.hypot(*v) * math.hypot(*query)
        return dot / size if size else None

    scored = [(score(v), i) for i, v in rows if v and len(v) == 5 and score(v) is not None]
    expected = [i for _, i in sorted(scored, key=lambda p: (-p[0], p[1]))[:7]]
    assert [r["vec_id"] for r in nearest(vectors, query, 7, metric).collect()] == expected
    asked = spark.createDataFrame([(1, query), (2, [-x for x in query])], "vec_id long, embedding array<double>")
    batch = nearest_batch(vectors, asked, 7, metric).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in batch if r["query_id"] == 1] == expected
    assert [r["rank"] for r in batch] == list(range(1, 8)) * 2


def test_a_batch_in_other_blocks(spark):
    vectors = tables.read_table(spark, DATA, "embeddings")
    asked = vectors.filter("vec_id < 40")
    once = nearest_batch(vectors, asked, 3).orderBy("query_id", "rank").collect()
    assert nearest_batch(vectors, asked, 3, block_numbers=1 << 20, slice_numbers=11_000).orderBy("query_id", "rank").collect() == once
    assert len(once) == 120
    plan = nearest_batch(vectors, asked, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# ---- reports

def test_latency_report(spark):
    rows = [("a", "m1", 1.0), ("a", "m1", 3.0), ("a", "m2", 2.0), ("a", "m2", 6.0), ("a", "m3", 0.5)]
    summary = report.latency_summary(spark.createDataFrame(rows, "label string, method string, ms double"))
    got = {r["method"]: (r["avg"], r["median"], round(r["stdev"], 6), r["n"]) for r in summary.collect()}
    assert got == {"m1": (2.0, 2.0, 1.414214, 2), "m2": (4.0, 4.0, 2.828427, 2), "m3": (0.5, 0.5, 0.0, 1)}
    assert report.winners(summary).first().asDict() == {"label": "a", "winner": "m3", "factor": 8.0}
    zero = spark.createDataFrame([("a", "x", 0.0), ("a", "y", 1.0)], "label string, method string, avg double")
    assert report.winners(zero).first()["factor"] == math.inf


@pytest.mark.parametrize("limit", [100_000, 1000, 3])
@pytest.mark.parametrize("spread", ["skewed", "equal", "dense", "negative", "outlier"])
def test_percentiles_are_exact(spark, monkeypatch, spread, limit):
    """By counted values, by buckets, or some groups by the one and some by the other."""
    monkeypatch.setattr(report, "DISTINCT", limit)
    n = 5_000
    value = {"skewed": "exp(id % 997 / 60.0)", "equal": "4.5", "dense": "1000 + id / 1e9", "negative": "id - 2500.0", "outlier": "if(id = 0, 0, 1e9 + id)"}[spread]
    rows = spark.range(n).select(F.expr("if(id % 3 < 2, 'hot', cast(id % 7 as string))").alias("g"),
                                 F.expr(f"cast({value} as double)").alias("ms"))
    rows = rows.union(spark.sql("SELECT CAST(NULL AS STRING), 3.0D UNION ALL SELECT 'hot', CAST(NULL AS DOUBLE)"))
    wanted = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "low": 0.0, "high": 1.0}
    got = {r["g"]: r for r in report.exact_percentiles(rows, ["g"], "ms", wanted).collect()}
    expected = {r["g"]: r["p"] for r in rows.groupBy("g").agg(F.percentile("ms", list(wanted.values())).alias("p")).collect()}
    assert set(got) == set(expected)
    for group, values in expected.items():
        assert [got[group][name] for name in wanted] == pytest.approx(values, rel=1e-12)


def test_summaries_of_wide_groups(spark, monkeypatch):
    rows = spark.range(4000).select(F.expr("if(id % 4 < 3, 'hot', if(id % 8 = 3, null, 'some'))").alias("g"), F.expr("cast(sqrt(id) as double)").alias("ms"))
    rows = rows.union(spark.sql("SELECT 'none', CAST(NULL AS DOUBLE)"))
    once = {r["g"]: tuple(r)[1:] for r in report.latency_summary(rows, ["g"]).collect()}
    monkeypatch.setattr(report, "DISTINCT", 1500)
    split = {r["g"]: tuple(r)[1:] for r in report.latency_summary(rows, ["g"]).collect()}
    assert set(once) == {"hot", "some", None, "none"} and once == {k: pytest.approx(v, rel=1e-12) if None not in v else v for k, v in split.items()}
    plan = report.latency_summary(tables.read_table(spark, DATA, "events"), ["event_type"], "value")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 6 and plan.count("FileScan") == 1


def test_report_sections(spark):
    rows = spark.createDataFrame([(20, False), (0, False), (20, True)], "limit int, negated boolean")
    assert [r[0] for r in rows.select(report.section(F.col("limit"), F.col("negated"))).collect()] == ["dense", "selective", "negation"]


# ---- sources

def test_ensure_table(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "t")
    versions = Versions(spark, path)

    def write(first, n=3):
        spark.range(first, first + n).write.mode("overwrite").parquet(source)

    def ensure(**options):
        return keys(tables.ensure_table(spark, path, lambda: spark.read.parquet(source).withColumn("x", F.lit("x")), **options), "id")

    write(0)
    assert ensure(expected_rows=3, required_columns=["x"]) == [0, 1, 2]
    before = versions.current()
    assert ensure(expected_rows=3, required_columns=["x"]) == [0, 1, 2] and versions.current() == before, "used again"
    write(10)
    assert ensure(expected_rows=3) == [10, 11, 12], "a changed source of equal size is read again"
    before = versions.current()
    assert ensure(reset=True) == [10, 11, 12] and versions.current().number == before.number + 1
    tables.append(spark.range(5, 6).withColumn("x", F.lit("y")), f"{versions.current().folder}/rows")
    assert ensure() == [10, 11, 12], "rows that came by another way"
    tables.rebuild(spark.read.parquet(source).select(F.col("id").cast("int"), F.lit("x").alias("x")), f"{versions.current().folder}/rows")
    assert tables.ensure_table(spark, path, lambda: spark.read.parquet(source).withColumn("x", F.lit("x"))).schema["id"].dataType.simpleString() == "bigint"
    assert tables.stored(spark, str(tmp_path / "missing")) is None


def test_versions(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    assert versions.all() == [] and versions.current() is None
    made = []

    def write(folder):
        made.append(folder)
        spark.range(len(made)).write.parquet(folder)

    first = versions.publish(write, "a")
    reader = spark.read.parquet(first.folder)
    assert versions.ensure("a", write) == first.folder and len(made) == 1
    second = versions.ensure("b", write)
    assert reader.count() == 1 and spark.read.parquet(second).count() == 2, "readers keep their version"

    def broken(folder):
        write(folder)
        raise RuntimeError("the writer died")

    with pytest.raises(RuntimeError):
        versions.publish(broken, "c")
    assert versions.current().folder == second, "without a pointer there is no version"
    third = versions.publish(write, "c")
    assert [v.number for v in versions.all()] == [3, 2] and not os.path.exists(first.folder) and os.path.exists(third.folder)
    assert versions.ensure("c", write, lambda folder: False) != third.folder


def test_a_later_application_finds_the_table(spark, tmp_path):
    """In a program of its own, with another application id."""
    source, path = str(tmp_path / "source"), str(tmp_path / "t")
    spark.range(7).write.parquet(source)
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from logsieve.session import local_session
from logsieve.sources import tables
spark = local_session("first", cores=1, memory="1g")
print(spark.sparkContext.applicationId, tables.ensure_table(spark, {path!r}, lambda: spark.read.parquet({source!r})).count())
"""
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180, check=True).stdout.split()
    assert told[-1] == "7" and told[0] != spark.sparkContext.applicationId
    before = Versions(spark, path).all()
    assert len(before) == 1
    assert tables.ensure_table(spark, path, lambda: spark.read.parquet(source)).count() == 7 and Versions(spark, path).all() == before


def test_small_tables_have_a_file_for_each_task(spark, tmp_path):
    rows = tables.read_table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    table = tables.ensure_table(spark, str(tmp_path / "t"), lambda: rows)
    assert len(table.inputFiles()) == spark.sparkContext.defaultParallelism and table.count() == rows.count()


def test_the_callers_settings_stay(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    tables.scratch_path(spark, "x")
    assert spark.conf.get("spark.checkpoint.dir", None) == before


def test_fields_present(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b string, c string")
    assert {tuple(r) for r in tables.fields_present(rows).collect()} == {("a", True), ("b", False), ("c", True)}


def test_json_documents(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"doc_id": 1, "content": "x", "metadata": {"type": "log", "server": "s"}}\n'
                                     '{"doc_id": 2, "content": "y", "metadata": {"endpoint": "/u"}}\n')
    rows = read_json_documents(spark, str(tmp_path)).orderBy("doc_id")
    assert rows.schema == DOCUMENTS
    assert [(r["metadata"]["type"], r["metadata"]["endpoint"]) for r in rows.collect()] == [("log", None), (None, "/u")]
    loose = read_json_documents(spark, str(tmp_path), OPEN_METADATA)
    assert {(r["bucket"], r["n"]) for r in facet(loose, find("content", "[xy]"), "metadata.type").collect()} == {("log", 1), (None, 2)}


def test_stream_search_equals_table_search(spark, docs, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs.select("doc_id", "content").repartition(3).write.parquet(source)
    clause = compound(filter=[text("content", "license")], must=[find("content", "icense")])
    stream = spark.readStream.schema("doc_id long, content string").option("maxFilesPerTrigger", 1).parquet(source)
    running = (search_stream(stream, clause).writeStream.format("parquet").option("path", out)
               .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    running.awaitTermination()
    assert keys(spark.read.parquet(out)) == keys(search(docs, clause))
    with pytest.raises(ValueError):
        search_stream(docs, clause)
    assert os.path.isdir(out)
