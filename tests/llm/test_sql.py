"""Queries that SQL can express, against DuckDB."""

import pytest
from compare import differences, duck

from tradeloom.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), duck(SMALL), SQL[name]) == []
