"""The queries against their SQL twins, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracles import compare, database
from logsieve.llm.common import stored, table
from logsieve.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(DATA)


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert compare(spark, con, DATA, QUERIES[name], ORACLES[name]) is None
    else:
        assert QUERIES[name](spark, DATA).count() > 0


def test_stages(spark):
    docs = table(spark, DATA, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stored(stage(spark, docs, DATA), "stage")
        assert docs.columns == columns and docs.dtypes == before.dtypes, name
        assert docs.where("length(text) <> n_chars").count() == 0
        if name != "mixing":
            assert docs.join(before, "doc_id", "left_anti").count() == 0 and docs.count() <= before.count()
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert ids.count() == docs.count() > 0 and "ids" in ids.columns


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
