"""Registered queries against their SQL on the smallest tables, and the driver's contract."""

import pytest

import __spark_entry__ as entry_points
from catalog.compare import connect, difference
from catalog.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, db, name):
    assert difference(spark, db, name, SF) is None


def test_entry_points(spark):
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) >= 75
    assert entry_points.entry(spark).columns == ["ds", "customer_code", "warehousecode", "Shop_SKU", "y"]
