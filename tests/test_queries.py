"""Every registered query runs, and equals its SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import difference, open_tables

QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(data) -> duckdb.DuckDBPyConnection:
    return open_tables(data)


def test_sql_only_for_registered_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    ours = QUERIES[name](spark, data).toPandas()
    if name in ORACLE:
        assert difference(ours, duck.execute(ORACLE[name]).df()) is None
    else:
        assert len(ours) > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 1
