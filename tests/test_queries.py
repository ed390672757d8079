"""Every registered query against its SQL, to the last digit, at the smallest scale."""

import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from worklens.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    found = differences(spark, con, REGISTRY[name].run, REGISTRY[name].sql, SF)
    assert found == []


def test_entry_point(spark):
    assert entry.entry(spark).count() > 0
    assert REGISTRY.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
