"""Queries for training data against DuckDB on the same tables."""

import pytest
from compare import database, differences

from tributary.llm import queries


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query(spark, folder, name):
    result = queries.QUERIES[name](spark, folder)
    assert differences(result, database(folder), queries.ORACLE_SQL[name]) == []
