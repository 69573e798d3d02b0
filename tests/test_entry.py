"""Every registered query against its SQL, at the smallest scale."""

import os
from pathlib import Path

import pytest
from oracle import connect, difference, rows_of_spark, rows_of_sql

import __spark_entry__ as entry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


OWN = {
    name
    for name, query in entry.queries().items()
    if ".llm." not in query.__module__ and query.__module__ != "corpus_pipeline"
}


def test_every_query_has_its_sql():
    assert OWN <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, con, name):
    names, rows = rows_of_spark(entry.queries()[name](spark, SF_DIR))
    sql_names, sql_rows = rows_of_sql(con, entry.oracle_sql()[name])
    assert names == sql_names
    assert difference(rows, sql_rows) == []
    assert rows


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
