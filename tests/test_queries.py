"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from checks.compare import difference, duckdb_over
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(SMALL)


#: What these return depends on the tasks that write; the tests below look at the written files.
WITHOUT_SQL = {"layout_bytes_by_release"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) | WITHOUT_SQL and not set(ORACLE) & WITHOUT_SQL
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, connection, name):
    result = QUERIES[name](spark, SMALL)
    assert difference(result, connection, ORACLE[name]) == ""


def test_entry_returns_the_fact(spark):
    fact = entry_points.entry(spark)
    assert fact.columns[0] == "company_root_cnpj" and len(fact.columns) == 26
    assert fact.count() > 0
