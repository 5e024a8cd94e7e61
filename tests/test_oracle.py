"""Every registered query runs; those with an SQL twin give its values."""

import pytest
from check import compare, duck

from riskloom.plans import registry


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, sf, con, name):
    assert compare(registry.QUERIES[name](spark, sf), con, registry.ORACLE.get(name)) == ""


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 1000
