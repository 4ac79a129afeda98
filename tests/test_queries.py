"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from tallyloom import registry
from tests.oracle import connect, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = registry.ORACLE


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    run = registry.QUERIES[name]
    if name in SQL:
        assert differences(spark, duck, SF, run, SQL[name]) == []
    else:
        assert run(spark, SF).count() > 0


def test_sql_has_queries():
    assert set(SQL) <= set(registry.QUERIES)
