"""Every registered query against its SQL counterpart, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, difference

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, folder, con, name):
    assert difference(spark, con, folder, queries()[name], SQL[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 40
