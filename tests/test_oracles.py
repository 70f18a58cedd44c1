"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from checks.verify import arrow, compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf, con):
    got = arrow(QUERIES[name](spark, sf))
    if name in SQL:
        assert compare(got, con.execute(SQL[name])) is None
    else:
        assert got.num_rows


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
