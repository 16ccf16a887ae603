"""Every registered query against its SQL on the given tables."""

import __spark_entry__ as entry
import pytest
from compare import check, duck

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    ok, *_ = check(spark, con, name, QUERIES[name], SQL.get(name), sf)
    assert ok is True, ok
