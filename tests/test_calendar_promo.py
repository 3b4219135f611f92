import datetime as dt

import pytest

from stockcast.operators import calendar, config, promo, scope
from stockcast.schemas import CONFIG, PROMOTION, REQUEST, SCOPE
from stockcast.settings import DEFAULT_SETTINGS
from stockcast.sources.tables import promotions_from_json, small_table

D = dt.date
SKU = "Shop_SKU string"


def _promo(mode, start, end, skus, discount=None):
    entries = None if skus is None else [{"sku_code": s, "discount_amount": 1.0, "discount_type": "Fixed"} for s in skus]
    return ("c", "n", "p", start, end, mode, discount, entries)


def _promotions(spark, rows):
    return small_table(spark, rows, PROMOTION)


def test_unknown_mode_fails(spark):
    with pytest.raises(Exception, match="EXCLUDE"):
        promo.promo_master(_promotions(spark, [_promo("exclude", "2001-01-01", "2001-01-02", ["a"])])).collect()


def test_master_modes(spark):
    rows = [
        _promo(None, "2001-01-01", "2001-01-02", None, {"amount": 5.0, "type": "Percent"}),
        _promo("include", "2001-01-01", "2001-01-02", ["a", None]),
        _promo("INCLUDE", "2001-01-01", "2001-01-02", None),
    ]
    got = promo.promo_master(_promotions(spark, rows)).collect()
    assert sorted((r.apply_mode, r.sku_code or "", r.discount_type) for r in got) == [
        ("ALL", "", "percent"), ("INCLUDE", "", "fixed"), ("INCLUDE", "a", "fixed"),
    ]


def test_daily_overlaps_reversed_and_malformed(spark):
    rows = [
        _promo("INCLUDE", "2001-01-01", "2001-01-03", ["a"]),
        _promo("INCLUDE", "2001-01-03", "2001-01-04", ["a", None]),
        _promo("INCLUDE", "2001-01-09", "2001-01-08", ["b"]),
        _promo("INCLUDE", "bad", "2001-01-08", ["b"]),
    ]
    valid = promo.promo_master_valid(promo.promo_master(_promotions(spark, rows)))
    got = sorted((r.ds.day, r.Shop_SKU, r.promo_flag) for r in promo.promo_daily(valid, None).collect())
    assert got == [(1, "a", 1), (2, "a", 1), (3, "a", 1), (4, "a", 1)]


def test_all_mode_needs_a_sku_list(spark):
    valid = promo.promo_master_valid(promo.promo_master(_promotions(spark, [_promo("ALL", "2001-01-01", "2001-01-02", None)])))
    with pytest.raises(ValueError):
        promo.promo_daily(valid, None)
    skus = small_table(spark, [("a",), ("b",), ("a",)], SKU)
    assert promo.promo_daily(valid, skus).count() == 4


def test_promotions_from_json_text(spark):
    text = '[{"customer_code":"c","start_date":"2001-01-01","end_date":"2001-01-01","include_sku":[{"sku_code":"z"},{"sku_code":""}]}]'
    parsed = promotions_from_json(small_table(spark, [(text,)], "promotions string"))
    assert [r.Shop_SKU for r in promo.promo_skus(parsed).collect()] == ["z"]
    assert promo.promo_master(parsed).first().apply_mode == "ALL"


def test_promo_holidays_need_windows(spark):
    with pytest.raises(ValueError):
        calendar.promo_holidays(small_table(spark, [], "ds date, Shop_SKU string, promo_flag int"), None)


def test_holidays_without_window_columns_and_bad_rows(spark):
    rows = [("holiday", "2001-04-13"), ("holiday", "2001-04-13"), (None, "2001-01-01"), ("holiday", "bad"), ("else", "2001-01-01")]
    base = calendar.base_holidays(small_table(spark, rows, "holiday_code string, ds string"))
    assert sorted((r.holiday, r.lower_window, r.upper_window) for r in base.collect()) == [("else", 0, 0), ("holiday", 0, 0)]
    assert calendar.toggle_holidays(base).count() == 1
    assert calendar.toggle_holidays(base, use_public_holiday=False).count() == 0


def test_holiday_features_spread_the_window(spark):
    rows = small_table(spark, [("h", D(2001, 1, 10), -1, 1)], "holiday string, ds date, lower_window int, upper_window int")
    got = sorted((r.ds.day, r.feature) for r in calendar.holiday_features(rows).collect())
    assert got == [(9, "h_minus_1"), (10, "h_plus_0"), (11, "h_plus_1")]


def test_flatten_override_takes_old_and_new_places():
    flat = config.flatten_override(
        {"prophet": {"seasonality_mode": "additive"}, "advanced": {"impact_dates": {"cv_bands": [0.1, 0.2], "top_skus_n": 3}},
         "promo": {"use_promotions": False, "holiday_upper_window": 2}, "lag_features": {"lag_days": [2]}}
    )
    assert flat == {
        "prophet_seasonality_mode": "additive", "impact_top_skus_n": 3, "impact_cv_band_low": 0.1,
        "impact_cv_band_high": 0.2, "use_promotions": False, "promo_upper_window": 2, "lag_days": [2],
    }
    assert config.flatten_override(None) == {}
    assert config.zscore_rules([{"window": 0, "threshold": 1}, {"window": "4", "threshold": "1.5"}, "x"]) == [(4, 1.5)]
    assert len(config.zscore_rules(None)) == 3


def _config(spark, rows):
    blank = {name: None for name in CONFIG.replace(",", " ").split()[::2]}
    names = [part.split()[0] for part in CONFIG.split(", ")]
    table = [tuple({**blank, "is_active": True, **row}.get(n) for n in names) for row in rows]
    return small_table(spark, table, CONFIG)


def test_lookup_prefers_warehouse_then_newest_with_null_first(spark):
    t = dt.datetime(2001, 1, 1)
    table = _config(
        spark,
        [
            {"customercode": "a", "warehousecode": "w", "impact_top_skus_n": 1, "updated_at": t},
            {"customercode": "a", "warehousecode": "w", "impact_top_skus_n": 2, "updated_at": None},
            {"customercode": "a", "warehousecode": None, "impact_top_skus_n": 3, "updated_at": t},
            {"customercode": "a", "warehousecode": "v", "impact_top_skus_n": 4, "updated_at": t, "is_active": False},
        ],
    )
    pairs = small_table(spark, [("a", "w"), ("a", "v"), ("a", None), ("b", "w")], "customer_code string, warehousecode string")
    got = {(r.customer_code, r.warehousecode): r.impact_top_skus_n for r in config.lookup_config(pairs, table).collect()}
    assert got == {("a", "w"): 2, ("a", "v"): 3, ("a", None): 3, ("b", "w"): None}
    full = config.effective_config(config.lookup_config(pairs, table), {"impact_top_skus_n": 7}).collect()
    assert {r.impact_top_skus_n for r in full} == {7}
    assert {tuple(r.lag_days) for r in full} == {tuple(DEFAULT_SETTINGS["lag_days"])}


def test_scope_resolution(spark):
    source = small_table(spark, [("a ", "n2", "w1", None), ("a", "n1", "w1", "x"), ("a", "n", " ", "x"), (None, "n", "w", "x"), ("b", "n", "w2", "x")], SCOPE)
    pairs = scope.scope_pairs(source)
    assert sorted(map(tuple, pairs.collect())) == [("a", "w1", "n1", ""), ("b", "w2", "n", "x")]
    requests = small_table(spark, [("a", []), ("b", ["w9", None, "w9"]), ("nobody", None)], REQUEST)
    assert sorted(map(tuple, scope.resolve_scope(pairs, requests).collect())) == [("a", "w1"), ("b", "w9")]
    assert scope.resolve_scope(pairs).count() == 2
