"""Every registered query against its SQL in an independent engine, over the whole tables."""

import pytest
from conftest import SF_DIR
from parity import compare, oracle_connection

import __spark_entry__ as entry
from logweir.registry.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, sf_dir, name):
    rows, problems = compare(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name])
    assert not problems
    assert rows > 0
