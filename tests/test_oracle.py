"""Every registered query against its SQL."""

import pytest
from compare import differences, duck
from conftest import TABLES

import __spark_entry__ as driver
from tradeloom.workload.queries import QUERIES


SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(TABLES)


def test_every_query_has_sql():
    assert {*QUERIES} <= SQL.keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, connection, name):
    assert differences(driver.queries()[name](spark, TABLES), connection, SQL[name]) == []


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "employee_id" and df.count() > 0
