"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry_point
from tools.check import compare, open_tables

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def database(sf_dir):
    return open_tables(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, database, sf_dir):
    assert compare(QUERIES[name](spark, sf_dir).toPandas(), database.execute(ORACLES[name]).df()) == ""


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_queries_without_sql_return_rows(spark, sf_dir):
    for name in set(QUERIES) - set(ORACLES):
        assert QUERIES[name](spark, sf_dir).count() > 0, name


def test_entry(spark):
    rows = entry_point.entry(spark)
    assert "hourly_facility_id" in rows.columns and not rows.isEmpty()
