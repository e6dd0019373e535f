"""Corpus queries against their SQL in DuckDB, whole results at the smallest scale."""

import pytest

from logweir.llm.oracle import ORACLE
from logweir.llm.queries import QUERIES
from tests.parity import compare, oracle_connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf_dir, name):
    rows, problems = compare(QUERIES[name](spark, sf_dir), oracle_connection(sf_dir), ORACLE[name])
    assert rows > 0 and not problems
