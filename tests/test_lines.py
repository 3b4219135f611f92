"""The joined order lines that the queries' inputs come from."""

import datetime as dt
from collections import Counter

import pytest

from catalog import fixtures as fx
from catalog.queries import REGISTRY
from stockcast.sources import tables
from stockcast.sources.tables import small_table

DAY = dt.datetime(2000, 5, 1)
ROWS = {
    "region": [(0, "ASIA"), (1, "EUROPE")],
    "nation": [(0, "X", 0), (1, "Y", 1), (2, None, None)],
    "customer": [(1, "a", 0, 9500.0, "MACHINERY"), (1, "a2", 1, 10.0, "FURNITURE"), (None, "b", 1, 1.0, "FURNITURE"), (3, "c", 1, 2.0, "FURNITURE")],
    "supplier": [(1, "s", 0, 1.0), (2, "t", 1, 1.0), (2, "t", 1, 1.0), (None, "u", 0, 1.0), (4, "v", 2, 1.0)],
    "part": [(1, "p", "Brand#1", "t", 1, 1.0), (2, "q", None, "t", 1, 1.0), (None, "r", "Brand#3", "t", 1, 1.0)],
    "orders": [(k, c, "O", 499_500.0 if k == 5 else 100_000.0 * (k or 1), DAY + dt.timedelta(k or 0), "1") for k, c in [(1, 1), (2, 3), (2, 3), (None, 1), (4, None), (5, 3)]],
    "lineitem": [
        (o, p, s, 1 + n % 7, 10.0 + n, 1.0, 0.1, 0.0, "R", "O", None if n == 5 else DAY + dt.timedelta(9 * n))
        for n, (o, p, s) in enumerate([(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 1, 2), (2, None, 1), (1, 1, 1), (None, 1, 1), (4, 1, 1), (5, 1, 4), (5, 1, 2)])
    ],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("lines")
    for name, rows in ROWS.items():
        small_table(spark, rows, fx.TABLES[name]).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_lines_are_the_rows_of_the_plain_join(spark, folder):
    read = {name: spark.read.schema(fx.TABLES[name]).parquet(f"{folder}/{name}.parquet") for name in ROWS}
    columns = ", ".join(fx.LINE_COLUMNS)
    plain = spark.sql(f"select {columns} " + fx.FROM_ALL, **{n: read[n] for n in ROWS}).collect()
    assert len(plain) > 5 and Counter(map(tuple, fx.lines(spark, folder).collect())) == Counter(map(tuple, plain))


#: queries by how often they read the order lines: once for all their inputs, and once more for the promotions
READS = {
    "scoped_replace": 1,
    "series_holidays": 1,
    "forecast_promo_flag": 2,
    "forecast_route_all_promoted": 2,
    "series_features": 2,
}


@pytest.mark.parametrize("name", list(READS))
def test_order_lines_are_read_once(spark, folder, monkeypatch, name):
    seen, read = [], tables.read_table
    monkeypatch.setattr(tables, "read_table", lambda s, path, *a, **k: seen.append(path) or read(s, path, *a, **k))
    REGISTRY[name](spark, folder).collect()
    assert sum(path.endswith("/lineitem.parquet") for path in seen) == READS[name]
