"""Every registered query against its SQL equivalent, on whole tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert registry.entry(spark).count() == 919


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in SQL:
        assert compare(spark, con, QUERIES[name], SQL[name], SF) == ""
    else:
        assert QUERIES[name](spark, SF).count() > 0
