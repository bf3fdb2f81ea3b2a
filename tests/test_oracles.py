"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, database
from logsieve.plans import queries as _  # noqa: F401  (fills the registry)
from logsieve.plans.registry import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(DATA)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_the_entry_has_them_all():
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and "error_lines" in rows.columns


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, DATA, QUERIES[name], ORACLES[name]) is None
