import random

import pytest
from pyspark.sql import functions as F

from stockcast import SERIES
from stockcast.operators import impact, ranking, routing
from stockcast.sources.tables import small_table

VOLUMES = "customer_code string, warehousecode string, Shop_SKU string, volume double"


def _volumes(spark, n=600, hot=400):
    """One pair holds two thirds of the series, with many equal volumes."""
    rng = random.Random(7)
    return [
        ("hot" if i < hot else f"c{i % 9}", "w", f"s{i:04d}", float(rng.choice([0, 1, 1, 1, 2, 5, 9, 40, -3]))) for i in range(n)
    ]


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_running_total_matches_brute_force(spark, partitions):
    rows = _volumes(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        table = small_table(spark, rows, VOLUMES)
        got = ranking.running_total(
            table, ["customer_code"], [F.desc("volume"), F.asc("Shop_SKU")], "volume", "running"
        ).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want, totals = {}, {}
    for customer, _, sku, volume in sorted(rows, key=lambda r: (r[0], -r[3], r[2])):
        totals[customer] = totals.get(customer, 0.0) + volume
        want[customer, sku] = totals[customer]
    assert {(r.customer_code, r.Shop_SKU): r.running for r in got} == want


def test_top_n_is_exact_in_a_hot_group(spark):
    rows = _volumes(spark)
    got = ranking.top_n(
        small_table(spark, rows, VOLUMES), ["customer_code"], [F.desc("volume"), F.asc("Shop_SKU")], 25, salts=4
    ).collect()
    for customer in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == customer), key=lambda r: (-r[3], r[2]))[:25]
        mine = sorted((r for r in got if r.customer_code == customer), key=lambda r: r["rank"])
        assert [r.Shop_SKU for r in mine] == [r[2] for r in ordered]


def test_pareto_takes_the_largest_when_it_alone_exceeds_the_share(spark):
    rows = [("a", "w", "big", 90.0), ("a", "w", "small", 10.0), ("b", "w", "x", 40.0), ("b", "w", "y", 40.0), ("b", "w", "z", 20.0)]
    got = routing.pareto_series(small_table(spark, rows, VOLUMES)).collect()
    assert {(r.customer_code, r.Shop_SKU) for r in got} == {("a", "big"), ("b", "x"), ("b", "y")}


def test_route_with_and_without_promotions(spark):
    keys = small_table(spark, [("a", "w", "big"), ("a", "w", "small"), ("a", "w", "promo")], "customer_code string, warehousecode string, Shop_SKU string")
    pareto = keys.filter("Shop_SKU = 'big'")
    promos = small_table(spark, [("promo", 1), ("unknown", 1)], "Shop_SKU string, promo_flag int")
    plain = routing.route(keys, routing.model_series(pareto, keys, None)).collect()
    promoted = routing.route(keys, routing.model_series(pareto, keys, promos)).collect()
    assert {r.Shop_SKU: r.method for r in plain} == {"big": "structural", "small": "poisson", "promo": "poisson"}
    assert {r.Shop_SKU: r.method for r in promoted} == {"big": "structural", "small": "poisson", "promo": "structural"}


def _series(spark, values, sku="s"):
    import datetime as dt

    first = dt.date(2001, 1, 1)
    rows = [(first + dt.timedelta(i), "c", "w", sku, float(v)) for i, v in enumerate(values)]
    return small_table(spark, rows, "ds date, customer_code string, warehousecode string, Shop_SKU string, y double")


def test_lone_sale_among_zeros_is_an_impact_date_and_constant_series_is_not(spark):
    lone = _series(spark, [0] * 12 + [3] + [0] * 12)
    flat = _series(spark, [4] * 25, "flat")
    rows = lone.unionByName(flat)
    top = rows.select(*SERIES).distinct()
    got = impact.impact_dates(rows, top).collect()
    assert [str(r.ds) for r in got] == ["2001-01-13"]


def test_zscore_rule_by_band_and_short_rule_list(spark):
    rows = _series(spark, [10, 11, 10, 11, 10, 11, 10, 11, 10, 11, 10])
    top = rows.select(*SERIES).distinct()
    scored = impact.zscore_detail(rows, top)
    assert {r.rule for r in scored.select("rule").distinct().collect()} == {0}
    assert scored.filter("z_score is not null").count() == 2
    wild = _series(spark, [0, 0, 0, 0, 0, 90])
    one_rule = impact.zscore_detail(wild, top, rules=[(3, 1.0)])
    assert {(r.rule, r.threshold) for r in one_rule.collect()} == {(0, 1.0)}
