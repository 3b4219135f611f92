import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockcast.operators import clean, demand
from stockcast.plans.preparation import prepare_demand
from stockcast.schemas import DEMAND, ORDER_LOG, SHIPMENT_LOG
from stockcast.sources import stores
from stockcast.sources.tables import jdbc_options, read_optional, read_table, scan_shipments, small_table, sku_renames

D = dt.date
RENAMES = "customer_code string, old_sku string, new_sku string"


def test_adapt_takes_first_of_repeated_columns_and_warehouse_names(spark):
    raw = spark.sql("select '2001-01-01' ds, 'c' customer_code, 'a' sku, 'b' Shop_SKU, '1' y, 'w1' WH_CODE, 'w2' warehouse_code")
    row = clean.adapt(raw, "gi").first()
    assert (row.Shop_SKU, row.warehousecode, row.paymentdate) == ("a", "w2", None)


def test_adapt_without_warehouse_column_gives_null(spark):
    raw = spark.sql("select '2001-01-01' gi_date, 'c' customercode, 'a' sku, '1' qty")
    assert clean.clean(clean.adapt(raw, "gi"), "2002-01-01").first().warehousecode == "None"


def test_clean_coerces_and_guards(spark):
    rows = [
        ("2001-01-01 10:00:00", " c ", "\tw\n", " s ", "2.5"),
        ("2001-01-02", None, None, "s", "n/a"),
        ("2001-01-02", "c", "w", "s", "NaN"),
        ("bad", "c", "w", "s", "1"),
        ("2001-01-02", "c", "w", None, "1"),
        ("2001-01-05", "c", "w", "s", "1"),
    ]
    raw = small_table(spark, rows, "gi_date string, customercode string, warehouse_code string, sku string, qty string")
    got = clean.clean(clean.adapt(raw, "gi"), "2001-01-05").select("ds", "customer_code", "warehousecode", "Shop_SKU", "y").collect()
    assert sorted(map(tuple, got)) == [
        (D(2001, 1, 1), "c", "w", "s", 2.5),
        (D(2001, 1, 2), "None", "None", "s", 0.0),
        (D(2001, 1, 2), "c", "w", "s", 0.0),
    ]


def test_rename_is_one_step_and_per_customer(spark):
    rows = small_table(spark, [("x", "A"), ("x", "B"), ("z", "A")], "customer_code string, Shop_SKU string")
    names = small_table(spark, [("x", "A", "B"), ("x", "B", "C")], RENAMES)
    got = sorted(map(tuple, clean.rename_skus(rows, names).collect()))
    assert got == [("x", "B"), ("x", "C"), ("z", "A")]


def test_default_renames_are_unique(spark):
    table = sku_renames(spark)
    assert table.count() == 26 == table.select("customer_code", "old_sku").distinct().count()


def test_scan_drops_rows_without_customer(spark):
    raw = small_table(spark, [("a",), (None,), ("X",)], "customercode string")
    assert [r.customercode for r in scan_shipments(raw, "X").collect()] == ["a"]


def test_missing_optional_source_is_empty(spark, tmp_path):
    orders = read_optional(spark, lambda: read_table(spark, str(tmp_path / "nowhere"), ORDER_LOG), ORDER_LOG)
    assert orders.count() == 0 and "paymentdate" in orders.columns


def test_optional_source_that_fails_while_it_is_read_is_empty(spark):
    def broken():
        return spark.range(10).selectExpr("case when id < 9 then cast(id as string) else raise_error('gone') end sku")

    assert read_optional(spark, broken, "sku string").count() == 0
    assert read_optional(spark, lambda: spark.range(10).selectExpr("cast(id as string) sku"), "sku string").count() == 10


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "t", partition_column="id", bounds=("0", "9"), num_partitions=3)
    assert options["fetchsize"] == "10000" and options["numPartitions"] == "3"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def _daily(spark, rows):
    return small_table(spark, rows, DEMAND)


def test_dense_fills_gaps_and_keeps_old_series(spark):
    daily = _daily(
        spark,
        [
            (D(2001, 1, 2), "c", "w", "gap", 5.0),
            (D(2001, 1, 4), "c", "w", "gap", 7.0),
            (D(2000, 12, 1), "c", "w", "old", 9.0),
            (D(2000, 12, 2), "c", "w", "old", 9.0),
            (D(2001, 1, 5), "d", "w", "one", 1.0),
        ],
    )
    got = {(r.Shop_SKU, r.ds.day): r.y for r in demand.dense_demand(daily, "2001-01-01").collect()}
    assert len(got) == 15
    assert [got["gap", d] for d in range(1, 6)] == [0, 5, 0, 7, 0]
    assert [got["old", d] for d in range(1, 6)] == [0] * 5
    assert [got["one", d] for d in range(1, 6)] == [0, 0, 0, 0, 1]


def test_dense_of_sales_before_the_start_is_empty(spark):
    assert demand.dense_demand(_daily(spark, [(D(2000, 1, 1), "c", "w", "s", 1.0)]), "2001-01-01").count() == 0


def test_prepare_with_empty_sources_is_empty(spark):
    empty = prepare_demand(
        small_table(spark, [], SHIPMENT_LOG), small_table(spark, [], ORDER_LOG), sku_renames(spark), as_of="2026-01-01"
    )
    assert empty.count() == 0 and empty.columns == ["ds", "customer_code", "warehousecode", "Shop_SKU", "y"]


def test_filter_customer_errors_only_for_unknown_customer(spark):
    rows = _daily(spark, [(D(2001, 1, 1), "c", "w", "s", 1.0)])
    with pytest.raises(ValueError, match="nobody"):
        demand.filter_customer(rows, "nobody")
    assert demand.filter_customer(rows, "c", "other").count() == 0
    assert demand.filter_customer(rows.drop("warehousecode"), "c", "other").count() == 1


def test_validation_names_the_reason(spark):
    rows = _daily(
        spark,
        [
            (D(2001, 1, 1), "ok", "w", "s", 1.0),
            (D(2001, 1, 2), "ok", "w", "s", 1.0),
            (D(2001, 1, 2), "single", "w", "s", 1.0),
            (D(2001, 1, 1), "zero", "w", "s", 0.0),
            (D(2001, 1, 2), "zero", "w", "s", 4.0),
            (None, "undated", "w", "s", 4.0),
        ],
    )
    checked = demand.validate_inputs(demand.series_stats(rows), rows)
    assert {r.customer_code: r.reason for r in checked.collect()} == {
        "ok": None,
        "single": "train is empty",
        "zero": "total volume is 0",
        "undated": "no valid ds",
    }
    with pytest.raises(ValueError):
        demand.validate_inputs(rows, None)


def test_missing_days_without_dates(spark):
    rows = _daily(spark, [(None, "c", "w", "s", 1.0), (D(2001, 1, 1), "d", "w", "s", 1.0), (D(2001, 2, 1), "e", "w", "s", 1.0)])
    got = {r.customer_code: (r.dif_days, r.last_ds) for r in demand.missing_days(rows, "2001-01-05").collect()}
    assert got == {"c": (0, None), "d": (3, D(2001, 1, 1)), "e": (0, D(2001, 2, 1))}


def test_dense_plan_shuffles_only_sales(spark):
    """The filled days are made after the last shuffle: explode sits above the window's exchange."""
    daily = _daily(spark, [(D(2001, 1, 2), "c", "w", "s", 5.0)]).repartition(3)
    plan = demand.dense_demand(daily, "2001-01-01")._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and plan.index("Generate") < plan.index("Window")


def test_stored_demand_keeps_codes_and_prunes_customers(spark, tmp_path):
    rows = _daily(spark, [(D(2001, 1, 2), "0000000811", "007", "s", 5.0), (D(2001, 1, 2), "2", "None", "t", 7.0)])
    stores.write_demand(rows, str(tmp_path / "demand"))
    stored = stores.read_demand(spark, str(tmp_path / "demand"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
    one = stored.filter("customer_code = '0000000811'")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(customer_code" in one._jdf.queryExecution().toString()


def test_numbers_and_days_are_read_strictly(spark):
    from stockcast.functions.columns import day, number

    cells = ["12", " 1.5 ", "-.5", "1e3", "12d", "7f", "inf", "NaN", "0x1F", "1e999", "", None]
    table = small_table(spark, [(c,) for c in cells], "c string")
    assert [r[0] for r in table.select(number(F.col("c"))).collect()] == [12.0, 1.5, -0.5, 1000.0, *[0.0] * 8]
    values = small_table(spark, [(1.5,), (float("inf"),), (float("nan"),), (None,)], "c double")
    assert [r[0] for r in values.select(number(F.col("c"))).collect()] == [1.5, 0.0, 0.0, 0.0]
    texts = ["2001-02-03", "2001-2-3 10:30:00", "T10:30", "10:30", "bad", "2001-13-01", "", None]
    got = [r[0] for r in small_table(spark, [(c,) for c in texts], "c string").select(day(F.col("c"))).collect()]
    assert got == [dt.date(2001, 2, 3), dt.date(2001, 2, 3), *[None] * 6]
