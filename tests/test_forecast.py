import datetime as dt
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockcast import SERIES
from stockcast.functions.poisson import quantile
from stockcast.functions.structural_fit import _sparse, fit_series, history_features
from stockcast.operators import config, features, fit_audit, poisson, post, structural
from stockcast.plans import scoring as score, training as train
from stockcast.schemas import DEMAND, HOLIDAY_SOURCE, PROMOTION
from stockcast.settings import DEFAULT_SETTINGS
from stockcast.sources import stores
from stockcast.sources.tables import small_table

D = dt.date
FIRST = D(2001, 1, 1)
DAY0 = (FIRST - D(1970, 1, 1)).days
ADDITIVE = {**DEFAULT_SETTINGS, "prophet_seasonality_mode": "additive"}


def test_poisson_quantiles_match_known_values_and_brute_force():
    for mean, bounds in {1: (0, 3), 5: (1, 10), 10: (4, 17), 50: (37, 64), 500: (457, 544), 0: (0, 0)}.items():
        assert tuple(quantile(mean, (0.025, 0.975))) == bounds
    total, k = math.exp(-3.7), 0
    while total < 0.6:
        k += 1
        total += math.exp(k * math.log(3.7) - 3.7 - math.lgamma(k + 1))
    assert quantile(3.7, 0.6) == k
    assert abs(quantile(1e6, 0.5) - 1e6) <= 1


def _demand(spark, series):
    rows = [(FIRST + dt.timedelta(i), c, w, s, float(v)) for (c, w, s), ys in series.items() for i, v in enumerate(ys)]
    return small_table(spark, rows, DEMAND)


def test_poisson_forecast_is_repeatable_and_zero_for_no_demand(spark):
    spans = small_table(
        spark,
        [("c", "w", "some", 4.0, FIRST, D(2001, 6, 30)), ("c", "w", "none", 0.0, FIRST, D(2001, 6, 30))],
        "customer_code string, warehousecode string, Shop_SKU string, rate double, first_ds date, last_ds date",
    )
    forecast = poisson.poisson_forecast(spans, 14)
    again = poisson.poisson_forecast(spans.repartition(7), 14)
    assert forecast.exceptAll(again).count() == 0 and forecast.count() == 2 * (181 + 14)
    none = forecast.filter("Shop_SKU = 'none'").agg(F.max("yhat"), F.max("yhat_upper")).first()
    assert tuple(none) == (0, 0)
    mean = forecast.filter("Shop_SKU = 'some'").agg(F.avg("yhat")).first()[0]
    assert 3.4 < mean < 4.6


def test_fit_recovers_slope_week_and_promotion():
    n = 400
    days = DAY0 + np.arange(n)
    promo = days[(np.arange(n) % 40) < 4]
    week = np.where((days + 3) % 7 == 5, 12.0, 0.0)
    y = 50 + 0.1 * np.arange(n) + week + 20.0 * np.isin(days, promo)
    # no lag can explain the pattern: one lag on a far day
    model = fit_series(days, y, promo, {}, {**ADDITIVE, "lag_days": [5], "rolling_mean_windows": [60], "promo_upper_window": -1})
    week_effect = np.array(model["weekly"]) * model["y_scale"]
    assert week_effect[5] - np.delete(week_effect, 5).mean() == pytest.approx(12, abs=1.5)
    flag = next(r for r in model["regressors"] if r["name"] == "promo_flag")
    assert flag["coef"] * model["y_scale"] == pytest.approx(20, abs=1.5)
    assert model["n_rows"] == n - 60 and model["yearly"] == []


def test_fit_turns_yearly_on_after_two_years_and_survives_constants():
    days = DAY0 + np.arange(800)
    model = fit_series(days, np.full(800, 3.0), [], {"h": days[:3]}, DEFAULT_SETTINGS)
    assert len(model["yearly"]) == 20 and model["sigma"] < 0.01
    zeros = fit_series(days[:50], np.zeros(50), [], {}, DEFAULT_SETTINGS)
    assert zeros["y_scale"] == 1.0
    with pytest.raises(ValueError):
        fit_series(days[:5], np.ones(5), [], {}, DEFAULT_SETTINGS)


def _fitted(spark, series, settings=None, promo=None):
    rows = _demand(spark, series)
    keys = config.with_defaults(rows.select(*SERIES).distinct(), settings)
    holidays = small_table(spark, [], "holiday string, ds date, lower_window int, upper_window int")
    return structural.fit_models(structural.fit_inputs(rows, keys, holidays, None, promo))


def test_absolute_penalty_finds_the_minimum_of_a_proximal_descent():
    rng = np.random.default_rng(3)
    ridge, weight = np.array([0.3, 0.3, *[0.0] * 10]), np.array([0.0, 0.0, *[8.0] * 10])
    for _ in range(10):
        design = rng.normal(size=(60, 12))
        target = design[:, :5] @ np.array([2.0, -1.0, 1.0, -0.5, 0.1]) + rng.normal(size=60)
        step, plain = 1.0 / (np.linalg.eigvalsh(design.T @ design).max() + 1.0), np.zeros(12)
        for _ in range(5000):
            plain = plain - step * (design.T @ (design @ plain - target) + ridge * plain)
            plain = np.sign(plain) * np.maximum(np.abs(plain) - step * weight, 0.0)
        for start in (np.zeros(12), rng.normal(size=12)):
            found = _sparse(design, target, ridge, weight, start)
            assert found == pytest.approx(plain, abs=1e-6)
            assert set(np.flatnonzero(found)) == set(np.flatnonzero(np.abs(plain) > 1e-9))


def test_bends_gather_at_a_planted_one_and_grow_fewer_with_the_prior_scale():
    t = np.arange(400.0)
    y = 100 + 0.2 * t + np.maximum(t - 200, 0.0) * 1.5 + np.random.default_rng(2).normal(0, 2, 400)
    settings = {**ADDITIVE, "lag_days": [], "rolling_mean_windows": [], "prophet_changepoint_range": 0.8}
    counts = []
    for scale in (0.5, 0.05, 0.01):
        model = fit_series(DAY0 + np.arange(400), y, [], {}, {**settings, "prophet_changepoint_prior_scale": scale})
        bends = np.abs(model["change_by"])
        near = np.abs(np.array(model["change_at"]) * model["span_days"] - 200) < 30
        assert bends[near].sum() > 0.8 * bends.sum() > 0
        counts.append(np.count_nonzero(bends))
    assert 25 > counts[0] > counts[1] > counts[2] and counts[2] <= 3


def test_proof_of_the_fit_from_document_and_demand(spark):
    rng = np.random.default_rng(4)
    values = {("c", "w", f"s{k}"): 20 + rng.poisson(5, 150) + 0.1 * k * np.maximum(np.arange(150) - 70, 0) for k in range(3)}
    values["c", "w", "flat"] = np.full(60, 3.0)
    promo = small_table(spark, [("s1", FIRST + dt.timedelta(days=k)) for k in range(30, 50)], "Shop_SKU string, ds date")
    promo = promo.selectExpr("ds", "Shop_SKU", "1 promo_flag")
    for mode in ("additive", "multiplicative"):
        fitted = _fitted(spark, values, {"prophet_seasonality_mode": mode}, promo)
        models = structural.parse_models(fitted).withColumn("prophet_changepoint_prior_scale", F.lit(0.5))
        proof = fit_audit.fit_proof(_demand(spark, values), models, promo).collect()
        assert len(proof) == 4 and all(-1e-9 < r.relative_gap < 1e-4 and r.effect_slope < 1e-4 for r in proof), proof
        bent = models.withColumn("model", F.col("model").withField("change_by", F.transform("model.change_by", lambda b: b + 0.01)))
        assert all(r.relative_gap > 1e-2 for r in fit_audit.fit_proof(_demand(spark, values), bent, promo).collect())


def test_prediction_in_spark_equals_the_model_in_numpy(spark):
    rng = np.random.default_rng(1)
    y = 30 + rng.poisson(5, 120) + 6 * np.sin(np.arange(120) * 2 * np.pi / 7)
    for mode in ("additive", "multiplicative"):
        fitted = _fitted(spark, {("c", "w", "s"): y}, {"prophet_seasonality_mode": mode})
        model = json.loads(fitted.first().model_json)
        got = structural.predict(structural.parse_models(fitted), 14).orderBy("ds").collect()
        assert len(got) == 113 + 14 and str(got[0].ds) == model["first_ds"]
        for row in (got[0], got[60], got[-1]):
            t = (row.ds - D.fromisoformat(model["first_ds"])).days / model["span_days"]
            trend = model["level"] + model["slope"] * t + sum(b * max(t - a, 0) for a, b in zip(model["change_at"], model["change_by"]))
            effect = model["weekly"][row.ds.weekday()] + sum(
                r["coef"] * ((0 if r["name"] == "promo_flag" else r["last"]) - r["center"]) / r["scale"] for r in model["regressors"]
            )
            value = trend * (1 + effect) if mode == "multiplicative" else trend + effect
            assert row.yhat == pytest.approx(value * model["y_scale"])
            assert row.yhat_lower <= row.yhat <= row.yhat_upper


def test_lag_features_agree_with_the_fit_and_the_last_known_values(spark):
    y = np.arange(20.0) ** 1.5
    rows = _demand(spark, {("c", "w", "s"): y})
    table = features.lag_features(rows).orderBy("ds").toPandas()
    for name, values in history_features(y, [1, 7], [3]).items():
        np.testing.assert_allclose(table[name].to_numpy(float), values)
    last = features.last_known_features(features.series_features(rows, None)).first()
    assert last.y_lag7 == y[12] and features.series_features(rows, None).count() == 13


def test_bad_series_is_reported_and_does_not_stop_others(spark):
    fitted = _fitted(spark, {("c", "w", "ok"): np.arange(60), ("c", "w", "short"): [1, 2, 3]})
    got = {r.Shop_SKU: r.error for r in fitted.collect()}
    assert got["ok"] is None and "fewer than 2 rows" in got["short"]


def _campaign(spark, *skus):
    entries = [{"sku_code": s, "discount_amount": 0.0, "discount_type": "fixed"} for s in skus]
    return small_table(spark, [("c1", "n", "p", "2001-05-10", "2001-05-20", "INCLUDE", None, entries)], PROMOTION)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    series = {("c1", "001", f"s{i}"): rng.poisson(2 + 8 * (i == 0), 130) for i in range(4)}
    series[("c2", "002", "only")] = rng.poisson(9, 130)
    series[("zero", "003", "none")] = np.zeros(130)
    rows = _demand(spark, series)
    holidays = small_table(spark, [("payday_dates", "2001-02-25", 0, 1)], HOLIDAY_SOURCE)
    folder = tmp_path_factory.mktemp("stores")
    pairs = small_table(spark, [("c1", "001"), ("c2", "002"), ("zero", "003"), ("nobody", "w")], "customer_code string, warehousecode string")
    status = train.train_pairs(
        rows, holidays, pairs, as_of="2001-05-13", promotions=_campaign(spark, "s3"),
        model_path=f"{folder}/models", publish_path=f"{folder}/published", bias_min_demand=1.0, bias_min_days=1,
    ).collect()
    return folder, {r.customercode: r for r in status}


def test_run_reports_each_pair(trained):
    _, status = trained
    assert status["c1"].ok and status["c1"].n_rows == 4 * 14  # the horizon grows by the two days the feed is behind
    assert status["c2"].ok and status["zero"].error == "total volume is 0" and status["nobody"].error == "no demand"


def test_run_publishes_and_rerun_replaces_only_its_pairs(spark, trained):
    folder, _ = trained
    path = f"{folder}/published"
    published = stores.read_published(spark, path)
    assert {r.warehousecode for r in published.collect()} == {"001", "002"}
    before = published.filter("customercode = 'c1'").count()
    rows = [(dt.datetime(2001, 6, 1), " c2", "002", "only", 5), (dt.datetime(2001, 6, 1), "c3", "", "x", 1)]
    batch = small_table(spark, rows, "ds timestamp, customercode string, warehousecode string, Shop_SKU string, yhat bigint")
    stores.replace_published(batch, path)
    stores.replace_published(batch, path)
    after = stores.read_published(spark, path)
    assert after.filter("customercode = 'c1'").count() == before
    assert [r.yhat for r in after.filter("customercode = 'c2'").collect()] == [5]
    assert after.filter("customercode = 'c3' and warehousecode is null").count() == 1
    stores.replace_published(batch.limit(0), path)
    assert stores.read_published(spark, path).count() == after.count()


def test_scoring_reads_the_newest_models(spark, trained):
    folder, _ = trained
    models = stores.read_models(spark, f"{folder}/models")
    assert {"s0", "s3", "only"} <= {r.Shop_SKU for r in models.collect()}
    assert models.filter("Shop_SKU = 's3'").first().object_path == "c1/001/s3.json"
    stores.write_models(models.withColumn("trained_at", F.col("trained_at") + F.expr("interval 1 day")), f"{folder}/models")
    newest = stores.read_models(spark, f"{folder}/models")
    assert newest.count() == models.select(*SERIES).distinct().count()
    forecast, status = score.score_promotions(newest, _campaign(spark, "s3", "absent"), customer_code="c1")
    rows = forecast.orderBy("ds").collect()
    assert len(rows) == 14 and {r.yhat >= 0 for r in rows} == {True}
    assert sum(r.promo_flag for r in rows) == 10
    found = {(r.customer_code, r.Shop_SKU): r.status for r in status.collect()}
    assert found == {("c1", "s3"): "ok", (None, "absent"): "missing model"}


STORED = "customer_code string, warehousecode string, Shop_SKU string, object_path string, model_json string, last_ds date, trained_at timestamp, run_id string"


def _stored(series, document, hour=6, run="r"):
    return ("c1", "w", series, f"c1/w/{series}.json", document, D(2001, 5, 1), dt.datetime(2001, 5, 2, hour), run)


def test_bad_documents_are_kept_apart_with_their_reason(spark, trained):
    folder, _ = trained
    good = stores.read_models(spark, f"{folder}/models").filter("Shop_SKU = 's3'").first().model_json
    documents = {"a": good, "b": "\n " + good, "c": "", "d": "<html>", "e": "[1]", "f": None, "g": "{}", "h": good[:40], "i": " \n "}
    table = small_table(spark, [_stored(k, v) for k, v in documents.items()], STORED)
    states = {r.Shop_SKU: r.state for r in stores.check_documents(table).collect()}
    bad = {"c": "empty", "d": "html", "e": "not json", "f": "empty", "g": "incomplete", "h": "broken json", "i": "empty"}
    assert states == {"a": "ok", "b": "ok", **bad}
    with pytest.raises(Exception, match="bad model document"):
        stores.usable_models(table).collect()
    forecast, status = score.score_promotions(table, _campaign(spark, *documents, "none"))
    got = {r.Shop_SKU: r.status for r in status.collect()}
    assert got == {"a": "ok", "b": "ok", **bad, "none": "missing model"}
    assert {r.Shop_SKU for r in forecast.select("Shop_SKU").distinct().collect()} == {"a", "b"}
    assert {r.Shop_SKU: r.reason for r in stores.split_models(table)[1].collect()} == bad


def test_the_later_run_of_a_day_wins(spark):
    """Whatever the documents look like, the moment of the run decides, then its id."""
    rows = [_stored("s", "zzz", 6, "r2"), _stored("s", "aaa", 9, "r1"), _stored("t", "zzz", 6, "r1"), _stored("t", "aaa", 6, "r2")]
    newest = stores.newest_models(small_table(spark, rows, STORED)).collect()
    assert {r.Shop_SKU: r.model_json for r in newest} == {"s": "aaa", "t": "aaa"}


def test_two_runs_of_one_day_keep_the_second(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = _demand(spark, {("c1", "w", "s3"): rng.poisson(5, 90)})
    holidays = small_table(spark, [], HOLIDAY_SOURCE)
    for mode, moment in (("multiplicative", "2001-04-01 02:00:00"), ("additive", "2001-04-01 14:00:00")):
        train.train_and_store(
            rows, holidays, str(tmp_path), as_of="2001-04-01", promotions=_campaign(spark, "s3"), run_at=moment,
            override={"prophet": {"seasonality_mode": mode}},
        )
    assert json.loads(stores.read_models(spark, str(tmp_path)).first().model_json)["mode"] == "additive"


def test_scoring_without_skus_is_an_error(spark):
    with pytest.raises(ValueError, match="No SKU"):
        score.score_promotions(small_table(spark, [], STORED), _campaign(spark))


def test_a_failing_draw_stops_its_pair_only(spark):
    rng = np.random.default_rng(9)
    series = {("c1", "w1", "a"): [float("inf")] * 40, ("c1", "w1", "b"): [float("inf")] * 40}
    series |= {("c2", "w2", s): rng.poisson(6, 40) for s in "ab"}
    pairs = small_table(spark, [("c1", "w1"), ("c2", "w2")], "customer_code string, warehousecode string")
    status = train.train_pairs(_demand(spark, series), small_table(spark, [], HOLIDAY_SOURCE), pairs, as_of="2001-02-10")
    got = {r.customercode: r for r in status.collect()}
    assert not got["c1"].ok and got["c1"].error and got["c1"].n_rows == 0
    assert got["c2"].ok and got["c2"].n_rows == 28


def test_large_means_use_the_normal_law():
    from stockcast.functions import poisson as law

    below, above = (law.quantile(m, (0.025, 0.5, 0.975)) for m in (law.LARGE_MEAN, law.LARGE_MEAN * (1 + 1e-9)))
    assert np.abs(below - above).max() <= 2
    assert np.abs(law.quantile(1e12, 0.5) - 1e12) <= 1


def test_request_rules_and_test_days_reach_the_job(spark):
    request = {"execution": {"test_days": "12"}, "advanced": {"impact_dates": {"zscore_rules": [{"window": "5", "threshold": 9}, {"window": -1, "threshold": 1}]}}}
    flat = config.flatten_override(request)
    assert flat["test_days"] == 12 and flat["zscore_rules"] == [(5, 9.0)]
    rng = np.random.default_rng(10)
    rows = _demand(spark, {("c", "w", "s"): rng.poisson(6, 60)})
    run = train.train_forecast(rows, small_table(spark, [], HOLIDAY_SOURCE), as_of="2001-03-02", override=request)
    assert run.test.count() == 12 and run.impact_dates.count() == 0


def test_forecast_rows_are_not_shuffled_for_their_flags(spark):
    """Flags come with each series' array of days: no exchange by day and SKU."""
    rng = np.random.default_rng(11)
    rows = _demand(spark, {("c1", "w", s): rng.poisson(6, 60) for s in ("s3", "x", "y")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = train.train_forecast(rows, small_table(spark, [], HOLIDAY_SOURCE), as_of="2001-03-02", promotions=_campaign(spark, "s3"))
        plan = run.forecast._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(ds" in line]


def test_a_promotion_can_count_for_its_customer_only(spark):
    rng = np.random.default_rng(12)
    rows = _demand(spark, {(c, "w", s): rng.poisson(6, 140) for c in ("c1", "c2") for s in ("s3", "x")})
    holidays = small_table(spark, [], HOLIDAY_SOURCE)
    for own, wanted in ((False, {"c1", "c2"}), (True, {"c1"})):
        run = train.train_forecast(rows, holidays, as_of="2001-05-21", promotions=_campaign(spark, "s3"), promo_by_customer=own)
        flagged = run.forecast.filter("promo_flag = 1").select("customer_code").distinct().collect()
        assert {r.customer_code for r in flagged} == wanted
        assert {r.customer_code for r in run.promo_summary.select("customer_code").distinct().collect()} == wanted


def test_promo_only_needs_promotions(spark, tmp_path):
    rows = _demand(spark, {("c", "w", "s"): range(30)})
    with pytest.raises(ValueError):
        train.train_and_store(rows, rows, str(tmp_path), as_of="2001-02-01")
    with pytest.raises(ValueError):
        train.train_and_store(rows, rows, str(tmp_path), as_of="2001-02-01", promotions=_campaign(spark))


def test_bias_correction_thresholds_and_rounding(spark):
    days = [FIRST + dt.timedelta(i) for i in range(5)]
    rows = [(d, "c", "w", s, y) for s, y in (("big", 10.0), ("small", 0.5)) for d in days]
    actual = small_table(spark, rows, DEMAND)
    forecast = actual.select("ds", *SERIES, F.when(F.col("Shop_SKU") == "big", 7.5).otherwise(0.0).alias("yhat"))
    found = post.bias_correction(actual, forecast, 20, 5)
    assert {r.Shop_SKU: r.correction for r in found.collect()} == {"big": 2.5, "small": 0.0}
    assert post.bias_correction(actual, forecast, 20, 6).agg(F.max("correction")).first()[0] == 0.0
    lone = small_table(spark, [(days[0], "c", "w", "big", 10.0), (days[0], "c", "w", "new", 2.5)], "ds date, customer_code string, warehousecode string, Shop_SKU string, yhat double")
    assert {r.Shop_SKU: r.yhat for r in post.apply_bias(lone, found).collect()} == {"big": 12, "new": 2}


def test_int_cleanup_and_output_shape(spark):
    values = [(0.5, 0), (1.5, 2), (2.5, 2), (-3.0, 0), (None, 0), (float("nan"), 0), (float("inf"), 0), (float("-inf"), 0)]
    table = small_table(spark, [(i, v) for i, (v, _) in enumerate(values)], "i int, yhat double")
    got = post.int_cleanup(table).orderBy("i").collect()
    assert [r.yhat for r in got] == [w for _, w in values]
    shaped = post.output_shape(spark.sql("select '2001-01-02' ds, 'c' customer_code, 'w' warehouse_code, 's' shop_sku, '3.9' yhat union all select 'bad', 'c', 'w', 's', 'x'"))
    row = shaped.first()
    assert shaped.count() == 1 and (row.ds, row.customercode, row.warehousecode, row.Shop_SKU) == (dt.datetime(2001, 1, 2), "c", "w", "s")
    assert row.yhat == 3
    with pytest.raises(KeyError):
        post.output_shape(spark.sql("select 1 yhat"))


def test_customer_run_skips_bad_warehouses_and_promotion_switch(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = _demand(
        spark,
        {("c1", "w1", "a"): rng.poisson(9, 90), ("c1", "w1", "b"): rng.poisson(1, 90), ("c1", "w2", "a"): np.zeros(90), ("c2", "w1", "a"): rng.poisson(9, 90)},
    )
    holidays = small_table(spark, [], HOLIDAY_SOURCE)
    everything, future = train.train_customer(
        rows, holidays, "c1", str(tmp_path), as_of="2001-04-01", promotions=_campaign(spark, "b"),
        override={"promo": {"use_promotions": False}},
    )
    assert {(r.customer_code, r.warehousecode) for r in everything.select("customer_code", "warehousecode").distinct().collect()} == {("c1", "w1")}
    assert everything.agg(F.max("promo_flag")).first()[0] == 0
    assert future.count() == 2 * 14
    # promotions are off, so the small promoted SKU keeps its Poisson draw and has no model
    assert {r.Shop_SKU for r in stores.read_models(spark, str(tmp_path)).collect()} == {"a"}


def test_promotion_retrain_covers_only_promoted_skus_of_the_customer(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = _demand(spark, {("c1", w, s): rng.poisson(5, 150) for w in ("w1", "w2") for s in ("s3", "other")})
    holidays = small_table(spark, [], HOLIDAY_SOURCE)
    status = train.retrain_promoted(
        rows, holidays, _campaign(spark, "s3", "absent"), str(tmp_path), as_of="2001-05-31", customer_code="c1"
    )
    assert {r.Shop_SKU: r.status for r in status.collect()} == {"s3": "uploaded", "absent": "no demand"}
    models = stores.read_models(spark, str(tmp_path))
    assert [r.object_path for r in models.collect()] == ["c1/prophet/s3.json"]


def test_no_join_or_window_on_the_pair_moves_demand_rows(spark):
    """With broadcasting off, demand rows are shuffled by series only, so a hot pair spreads."""
    from stockcast.operators import demand, impact
    from stockcast.session import materialize

    rows = materialize(_demand(spark, {("c", "w", s): range(40) for s in "ab"}))
    stats = materialize(demand.series_stats(rows))
    latest = demand.series_latest(stats)
    series = materialize(demand.train_volume(stats.join(latest, SERIES)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        train_rows = demand.train_split(rows, series)
        plan = impact.zscore_detail(train_rows, impact.top_series(series, 5))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    by_pair = [line for line in shuffles if "Shop_SKU" not in line.split("),")[0] and "_slice" not in line]
    assert len(by_pair) == 1  # the final ranking of the sliced top series, not the demand


def exchanged_rows(df):
    """Records written by each exchange of the plan that ran."""
    df.collect()
    counts = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            counts.append(node.metrics().apply("shuffleRecordsWritten").value())
        if kind == "AdaptiveSparkPlanExec":
            inner = [node.executedPlan()]
        elif kind.endswith("QueryStageExec"):
            inner = [node.plan()]
        else:
            inner = [node.children().apply(k) for k in range(node.children().size())]
        for child in inner:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return counts


def test_only_top_series_reach_an_exchange(spark):
    """With broadcasting off, the demand is cut at its scan: none of the many small series' rows is exchanged."""
    from stockcast.operators import demand, impact, prefilter
    from stockcast.session import materialize

    rng = np.random.default_rng(13)
    rows = materialize(_demand(spark, {("c", "w", f"s{k}"): rng.poisson(1 + 40 * (k < 5), 40) for k in range(400)}))
    stats = materialize(demand.series_stats(rows))
    series = materialize(demand.train_volume(stats.join(demand.series_latest(stats), SERIES)))
    top = materialize(impact.top_series(series, 5))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = impact.zscore_detail(impact.top_demand(rows, top), top)
        moved = exchanged_rows(found)
        whole = impact.zscore_detail(demand.train_split(rows, top), top)
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows.count() == 16_000 and found.count() == 5 * 39
    assert moved and max(moved) <= 5 * 40 + 40  # at most one series more by a shared slot
    assert prefilter.broadcasts(top) and prefilter.keep_wanted(rows, top, SERIES) is rows
    few = prefilter.keep_wanted(rows, top, SERIES, 1 << 16)
    assert few.join(top, SERIES, "left_semi").count() == 5 * 40


def test_runtime_filter_edges(spark):
    from stockcast.operators import prefilter

    rows = small_table(spark, [(None, "x"), ("a", None), ("a", "x"), ("", ""), ("b", "y")] * 2, "k string, v string")
    none = rows.filter("k = 'zz'")
    kept = lambda keys: prefilter.keep_wanted(rows, keys, ["k", "v"], 1 << 20)
    assert kept(none).count() == 0 and kept(rows).count() == 10
    assert {tuple(r) for r in kept(rows.filter("k = 'a'")).collect()} == {("a", None), ("a", "x")}
    many = rows.sparkSession.range(20_000).selectExpr("cast(id as string) k")
    held = prefilter.keep_wanted(many, many.filter("k % 10 = 0"), ["k"], prefilter.filter_bits(many.filter("k % 10 = 0")))
    assert held.filter("k % 10 = 0").count() == 2000 and held.count() < 2000 + 18_000 / 8


def _one_model(spark, mode="additive", **changed):
    body = {
        "mode": mode, "first_ds": "2001-01-01", "last_ds": "2001-04-10", "span_days": 99.0, "y_scale": 10.0, "slope": 0.4, "level": 0.2,
        "change_at": [0.3, 0.1, 0.7], "change_by": [0.5, -0.2, 0.1], "weekly": [0.01 * k for k in range(7)], "yearly": [],
        "holiday_effect": {"2001-01-01": 0.2, "2001-02-03": -0.1, "2001-04-20": 0.3, "2000-12-31": 9.0}, "sigma": 0.05, "n_rows": 100,
        "regressors": [{"name": "y_lag1", "coef": 0.1, "center": 2.0, "scale": 4.0, "last": 3.0}, {"name": "promo_flag", "coef": 0.3, "center": 0.0, "scale": 1.0, "last": 1.0}],
        **changed,
    }
    return small_table(spark, [("c", "w", "s", json.dumps(body))], "customer_code string, warehousecode string, Shop_SKU string, model_json string"), body


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
@pytest.mark.parametrize("include_history", [True, False])
def test_prediction_day_by_day(spark, mode, include_history):
    """Every day by itself: trend by its changepoints, season, holiday and regressors; bounds by the closed variance."""
    documents, body = _one_model(spark, mode)
    promoted = small_table(spark, [(dt.date(2001, 2, 3), "s", 1), (dt.date(2001, 4, 12), "s", 1), (dt.date(1999, 1, 1), "s", 1)], "ds date, Shop_SKU string, promo_flag int")
    got = {r.ds: r for r in structural.predict(structural.parse_models(documents), 30, promoted, include_history=include_history).collect()}
    first, last = dt.date(2001, 1, 1), dt.date(2001, 4, 10)
    days = [first + dt.timedelta(k) for k in range(130)]
    assert set(got) == {d for d in days if include_history or d > last}
    for ds, row in got.items():
        t = (ds - first).days / 99.0
        trend = 0.2 + 0.4 * t + sum(by * max(t - at, 0) for at, by in zip(body["change_at"], body["change_by"]))
        flag = int(ds in (dt.date(2001, 2, 3), dt.date(2001, 4, 12)))
        effect = 0.01 * ds.weekday() + body["holiday_effect"].get(str(ds), 0.0) + 0.1 * (3.0 - 2.0) / 4.0 + 0.3 * flag
        yhat = 10 * (trend + effect if mode == "additive" else trend * (1 + effect))
        factor = 1 if mode == "additive" else 1 + effect
        variance = 2 * 3 * (0.8 / 3) ** 2 * max(t - 1, 0) ** 3 / 3
        margin = 10 * structural.Z80 * np.sqrt(0.05**2 + factor**2 * variance)
        assert row.promo_flag == flag and np.allclose([row.yhat, row.yhat_lower, row.yhat_upper], [yhat, yhat - margin, yhat + margin])


def test_models_without_changepoints_or_holidays(spark):
    documents, _ = _one_model(spark, change_at=[], change_by=[], holiday_effect={}, weekly=[], regressors=[])
    rows = structural.predict(structural.parse_models(documents), 3).orderBy("ds").collect()
    assert np.allclose([r.yhat for r in rows], [10 * (0.2 + 0.4 * k / 99) for k in range(103)])
    assert np.allclose([r.yhat_upper - r.yhat for r in rows], 10 * structural.Z80 * 0.05)
    assert structural.predict(structural.parse_models(documents), 0, include_history=False).count() == 0


def test_no_exploded_row_carries_a_model(spark):
    documents, _ = _one_model(spark)
    promoted = small_table(spark, [(dt.date(2001, 2, 3), "s", 1)], "ds date, Shop_SKU string, promo_flag int")
    plan = structural.predict(structural.parse_models(documents), 30, promoted)._jdf.queryExecution().optimizedPlan()
    found = []

    def walk(node):
        if node.nodeName() == "Generate":
            found.append([node.requiredChildOutput().apply(k).dataType().simpleString() for k in range(node.requiredChildOutput().size())])
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(plan)
    assert found and not [kind for kinds in found for kind in kinds if kind.startswith(("array", "map", "struct"))]


def test_trend_uncertainty_equals_simulated_futures(spark):
    """Changepoints as a Poisson stream with Laplace sizes, drawn many times, have the closed variance."""
    documents, body = _one_model(spark, sigma=0.0)
    row = structural.predict(structural.parse_models(documents), 99, include_history=False).orderBy(F.desc("ds")).first()
    rng = np.random.default_rng(1)
    scale, rate, ahead = np.mean(np.abs(body["change_by"])), 3, 1.0
    ends = [np.sum(rng.laplace(0, scale, n) * (ahead - rng.uniform(0, ahead, n))) for n in rng.poisson(rate * ahead, 40_000)]
    assert abs((row.yhat_upper - row.yhat) / structural.Z80 / 10 - np.std(ends)) < 0.02 * np.std(ends)
