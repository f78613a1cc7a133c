"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import difference, duckdb_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duckdb_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(entry.catalogue_queries()) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.catalogue_queries()))
def test_same_result(spark, connection, name):
    mine = entry.queries()[name](spark, SF_DIR).toArrow()
    theirs = connection.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert difference(mine, theirs) == ""


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["pl_name", "hostname", "discoverymethod", "disc_year", "sy_dist"]
    assert result.count() == 10
