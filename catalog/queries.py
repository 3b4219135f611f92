"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from stockcast import PAIR, SERIES, schemas
from stockcast.operators import calendar, clean, config, demand, features, fit_audit, impact, poisson, post, promo, routing, scope, structural
from stockcast.plans import scoring as score, training as train
from stockcast.session import materialize, run_folder
from stockcast.settings import DEFAULT_SETTINGS
from stockcast.sources import stores, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, 6) for c in doubles})


def lists_as_text(df: DataFrame) -> DataFrame:
    lists = [f.name for f in df.schema if f.dataType.simpleString().startswith("array")]
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in lists})


def stored_demand(spark, sf, sold=None) -> DataFrame:
    """The demand table as the jobs after preparation get it: written once, then read."""
    return materialize(fx.demand(spark, sf, sold))


def _volumes(rows: DataFrame) -> DataFrame:
    """Training volume per series, stored: the rankings read it several times."""
    stats = materialize(demand.series_stats(rows))
    volumes = demand.train_volume(stats.join(demand.series_latest(stats), SERIES))
    return materialize(volumes.select(*SERIES, "volume"))


def campaign_daily(spark, keys: DataFrame | None = None) -> DataFrame:
    return promo.promo_daily(promo.promo_master_valid(promo.promo_master(fx.campaign(spark))), keys)


# --- scans and cleaning


@register
def scan_gi(spark, sf):
    return tables.scan_shipments(fx.shipments(spark, sf), fx.SPECIAL)


@register
def scan_orders(spark, sf):
    return tables.scan_orders(fx.orders(spark, sf), fx.SPECIAL).withColumn("paymentdate", F.col("paymentdate").cast("date"))


@register
def adapt_gi(spark, sf):
    return clean.adapt(fx.shipments(spark, sf), "gi")


@register
def adapt_order(spark, sf):
    return clean.adapt(fx.orders(spark, sf), "oms_order").withColumn("paymentdate", F.col("paymentdate").cast("date"))


@register
def clean_demand(spark, sf):
    return clean.clean(clean.adapt(fx.shipments(spark, sf), "gi"), fx.AS_OF)


@register
def sku_remap(spark, sf):
    return clean.rename_skus(clean.clean(clean.adapt(fx.orders(spark, sf), "oms_order"), fx.AS_OF), fx.renames(spark))


@register
def customer_rules(spark, sf):
    rows = clean.clean(clean.adapt(fx.orders(spark, sf), "oms_order"), fx.AS_OF)
    return clean.eligible_rows(rows, fx.SPECIAL, fx.CUTOFF)


@register
def union_sources(spark, sf):
    return fx.cleaned(spark, sf)


@register
def demand_profile(spark, sf):
    return rounded(clean.demand_profile(fx.cleaned(spark, sf)))


@register
def top_pairs(spark, sf):
    return rounded(clean.top_pairs(fx.cleaned(spark, sf)))


# --- demand


@register
def daily_demand(spark, sf):
    return demand.daily_demand(fx.cleaned(spark, sf))


@register
def series_keys(spark, sf):
    return demand.series_keys(fx.cleaned(spark, sf))


@register
def date_spine(spark, sf):
    return demand.date_spine(fx.cleaned(spark, sf), fx.START)


@register
def dense_demand(spark, sf):
    return demand.dense_demand(demand.daily_demand(fx.cleaned(spark, sf)), fx.START)


@register
def prep_demand(spark, sf):
    return fx.demand(spark, sf)


def _wanted_pairs(spark, sf, lines=None):
    """Pairs of the request; some of them have no demand."""
    return scope.resolve_scope(scope.scope_pairs(fx.scope(spark, sf, lines)), fx.requests(spark, sf))


@register
def filter_scope(spark, sf):
    lines = fx.lines(spark, sf)
    return demand.filter_scope(fx.demand(spark, sf, fx.sales(spark, sf, lines)), _wanted_pairs(spark, sf, lines))


@register
def validate_inputs(spark, sf):
    return rounded(demand.validate_inputs(demand.series_stats(fx.demand(spark, sf)), fx.holidays(spark, sf)))


@register
def train_split(spark, sf):
    return demand.train_split(stored_demand(spark, sf))


@register
def test_split(spark, sf):
    return demand.test_split(stored_demand(spark, sf), 30)


@register
def missing_days(spark, sf):
    # the sparse sales, where pairs end on different days
    return demand.missing_days(demand.daily_demand(fx.cleaned(spark, sf)), fx.AS_OF)


@register
def collapse_warehouses(spark, sf):
    return demand.collapse_warehouses(fx.demand(spark, sf), "prophet")


@register
def sku_volume(spark, sf):
    return demand.series_volume(demand.train_split(stored_demand(spark, sf)))


@register
def sku_cv(spark, sf):
    return rounded(demand.series_profile(demand.train_split(stored_demand(spark, sf))).drop("volume"))


@register
def top_skus(spark, sf):
    return impact.top_series(_volumes(stored_demand(spark, sf)), 10)


def _train_and_top(spark, sf, n, sold=None):
    """The top series with their pair's last day, and their demand before it: no other series' rows are cut."""
    rows = stored_demand(spark, sf, sold)
    stats = materialize(demand.series_stats(rows))
    series = materialize(demand.train_volume(stats.join(demand.series_latest(stats), SERIES)).select(*SERIES, "volume", "latest_date"))
    top = materialize(impact.top_series(series, n))
    return impact.top_demand(rows, top), top


@register
def zscore_detail(spark, sf):
    return rounded(impact.zscore_detail(*_train_and_top(spark, sf, 10)))


@register
def impact_dates(spark, sf):
    return impact.impact_dates(*_train_and_top(spark, sf, 30))


@register
def impact_dates_request(spark, sf):
    """Impact dates by the rules of a request, of which some entries are unusable."""
    given = [{"window": 7, "threshold": 2.25}, {"window": 0, "threshold": 1}, {"window": "x", "threshold": 1}, {"threshold": 2}, None]
    rules = config.flatten_override({"advanced": {"impact_dates": {"zscore_rules": given}}})["zscore_rules"]
    return impact.impact_dates(*_train_and_top(spark, sf, 30), rules)


@register
def pareto_skus(spark, sf):
    return routing.pareto_series(_volumes(stored_demand(spark, sf)))


@register
def sku_override(spark, sf):
    return routing.override_series(fx.demand(spark, sf), promo.promo_skus(fx.campaign(spark)))


# --- calendar


@register
def base_holidays(spark, sf):
    return calendar.base_holidays(fx.holidays(spark, sf))


@register
def holiday_toggles(spark, sf):
    settings = config.effective_config(config.lookup_config(_config_pairs(spark, sf), fx.config(spark, sf)))
    return calendar.toggle_holidays(calendar.base_holidays(fx.holidays(spark, sf)), settings)


def _impact_holidays(spark, sf, sold=None):
    return calendar.impact_holidays(impact.impact_dates(*_train_and_top(spark, sf, 30, sold)))


@register
def holidays_with_impact(spark, sf):
    base = calendar.toggle_holidays(calendar.base_holidays(fx.holidays(spark, sf)), use_public_holiday=False)
    return calendar.with_impact(base, _impact_holidays(spark, sf).select(*calendar.HOLIDAY_COLUMNS))


@register
def holiday_features(spark, sf):
    return calendar.holiday_features(calendar.base_holidays(fx.holidays(spark, sf)))


@register
def series_holidays(spark, sf):
    promo_days = calendar.promo_holidays(campaign_daily(spark), {"lower_window": 0, "upper_window": 1})
    sold = fx.sales(spark, sf)
    return calendar.series_holidays(demand.series_keys(sold), _impact_holidays(spark, sf, sold), promo_days)


# --- promotions


@register
def promo_master(spark, sf):
    return rounded(promo.promo_master(fx.promotions(spark, sf)))


@register
def promo_master_valid(spark, sf):
    return promo.promo_master_valid(promo.promo_master(fx.promotions(spark, sf)))


def _promo_days(spark, sf, skus):
    return promo.promo_daily(promo.promo_master_valid(promo.promo_master(fx.promotions(spark, sf))), skus)


@register
def promo_daily(spark, sf):
    return _promo_days(spark, sf, fx.cleaned(spark, sf))


@register
def promo_daily_by_customer(spark, sf):
    valid = promo.promo_master_valid(promo.promo_master(fx.promotions(spark, sf)))
    return promo.promo_daily(valid, fx.cleaned(spark, sf), by_customer=True)


@register
def promo_holidays(spark, sf):
    return calendar.promo_holidays(promo_daily(spark, sf), {"lower_window": -1, "upper_window": 2})


@register
def promo_skus(spark, sf):
    return promo.promo_skus(fx.promotions(spark, sf))


@register
def promo_worklist(spark, sf):
    return promo.promo_worklist(fx.promotions(spark, sf), fx.SPECIAL, 14)


@register
def promo_window(spark, sf):
    return promo.promo_window(promo_daily(spark, sf))


# --- features


@register
def lag_features(spark, sf):
    return rounded(features.lag_features(fx.demand(spark, sf)))


@register
def promo_regressor(spark, sf):
    return features.promo_regressor(fx.demand(spark, sf), campaign_daily(spark))


@register
def series_features(spark, sf):
    sold = fx.sales(spark, sf)
    return rounded(features.series_features(fx.demand(spark, sf, sold), _promo_days(spark, sf, sold), lags=[1, 7, 14], rolling=[3, 28]))


@register
def last_known_features(spark, sf):
    return rounded(features.last_known_features(features.series_features(fx.demand(spark, sf), None)))


@register
def promo_days_in_train(spark, sf):
    return features.promo_days_in_train(features.series_features(fx.demand(spark, sf), campaign_daily(spark)))


@register
def future_frame(spark, sf):
    return features.future_frame(demand.series_stats(fx.demand(spark, sf)), 14, campaign_daily(spark)).select("ds", *SERIES, "promo_flag")


# --- settings and scope


def _config_pairs(spark, sf):
    return scope.resolve_scope(scope.scope_pairs(fx.scope(spark, sf)))


@register
def config_coerce(spark, sf):
    typed = config.coerce_config(fx.config(spark, sf))
    shares = typed.withColumn("volume_share", config.clamp_share(F.col("prophet_changepoint_range") * 2))
    return lists_as_text(shares.withColumn("updated_at", F.col("updated_at").cast("string")))


@register
def config_lookup(spark, sf):
    return lists_as_text(config.lookup_config(_config_pairs(spark, sf), fx.config(spark, sf)))


@register
def config_effective(spark, sf):
    found = config.lookup_config(_config_pairs(spark, sf), fx.config(spark, sf))
    request = {
        "prophet": {"seasonality_mode": "additive", "changepoint_range": "12d"},
        "lag_features": {"lag_days": [7, -1, "x", 7, 3], "rolling_mean_windows": []},
        "advanced": {"impact_dates": {"top_skus_n": 0, "cv_bands": ["0.1", "high"]}},
    }
    return lists_as_text(config.effective_config(found, config.flatten_override(request)))


@register
def scope_pairs(spark, sf):
    return scope.scope_pairs(fx.scope(spark, sf))


@register
def resolve_scope(spark, sf):
    return _wanted_pairs(spark, sf)


# --- Poisson and routing


@register
def poisson_rate(spark, sf):
    return rounded(demand.series_stats(fx.demand(spark, sf)).select(*SERIES, "rate", "first_ds", "last_ds"))


@register
def poisson_quantiles(spark, sf):
    means = demand.daily_demand(fx.cleaned(spark, sf)).select(F.col("y").alias("mean"))
    return poisson.poisson_quantiles(means)


@register
def poisson_forecast(spark, sf):
    return poisson.poisson_forecast(demand.series_stats(fx.demand(spark, sf)), 14)


def _routes(spark, sf, promo_days, sold=None):
    rows = stored_demand(spark, sf, sold)
    keys = demand.series_keys(rows)
    pareto = routing.pareto_series(_volumes(rows))
    return keys, routing.model_series(pareto, keys, promo_days)


@register
def model_skus(spark, sf):
    return _routes(spark, sf, campaign_daily(spark))[1]


@register
def forecast_route(spark, sf):
    return routing.route(*_routes(spark, sf, campaign_daily(spark)))


@register
def forecast_route_all_promoted(spark, sf):
    """With one promotion on everything, every series gets the structural model."""
    sold = fx.sales(spark, sf)
    return routing.route(*_routes(spark, sf, _promo_days(spark, sf, sold), sold))


# --- post-processing


def _forecast(spark, sf, sold=None):
    return fx.stand_in_forecast(fx.demand(spark, sf, sold))


@register
def int_cleanup(spark, sf):
    return post.int_cleanup(fx.rough_forecast(spark, sf))


@register
def bias_correction(spark, sf):
    rows = stored_demand(spark, sf)
    return rounded(post.bias_correction(demand.test_split(rows, 30), fx.stand_in_forecast(rows), 50, 3))


@register
def bias_apply(spark, sf):
    rows = stored_demand(spark, sf)
    forecast = fx.stand_in_forecast(rows)
    corrections = post.bias_correction(demand.test_split(rows, 30), forecast, 50, 3)
    return rounded(post.apply_bias(forecast, corrections))


@register
def forecast_promo_flag(spark, sf):
    sold = fx.sales(spark, sf)
    return rounded(post.forecast_promo_flag(_forecast(spark, sf, sold), _promo_days(spark, sf, sold)))


@register
def promo_inspect(spark, sf):
    return rounded(promo.promo_inspect(_forecast(spark, sf), campaign_daily(spark)))


@register
def promo_summary(spark, sf):
    daily = campaign_daily(spark)
    return rounded(promo.promo_summary(post.forecast_promo_flag(_forecast(spark, sf), daily), daily))


@register
def production_window(spark, sf):
    rows = stored_demand(spark, sf)
    forecast = fx.stand_in_forecast(rows).join(demand.series_latest(demand.series_stats(rows)), SERIES)
    return rounded(post.production_window(forecast, "2001-11-03"))


@register
def output_shape(spark, sf):
    late = F.when(F.col("yhat") < 0, None).otherwise(F.col("ds"))
    return post.output_shape(_forecast(spark, sf).withColumn("ds", late))


@register
def scoped_replace(spark, sf):
    lines = fx.lines(spark, sf)
    sold = fx.sales(spark, sf, lines)
    forecast = materialize(_forecast(spark, sf, sold))
    old = post.output_shape(forecast)
    none = F.when(F.col("warehousecode") != "None", F.col("warehousecode"))
    old = old.withColumn("warehousecode", none).withColumn("yhat", F.lit(-1).cast("bigint"))
    padded = F.when(F.col("warehousecode") == "None", "").otherwise(F.concat(F.lit(" "), "warehousecode"))
    batch = post.output_shape(demand.filter_scope(forecast, _batch_pairs(spark, sf, sold, lines)))
    result = post.scoped_replace(old, batch.withColumn("warehousecode", padded))
    return result.withColumn("ds", F.col("ds").cast("date"))


def _batch_pairs(spark, sf, rows, lines):
    """The pairs that sold most, all warehouses of FURNITURE without a code, and the request."""
    none = rows.filter((F.col("warehousecode") == "None") & (F.col("customer_code") == "FURNITURE"))
    return clean.top_pairs(rows).select(*PAIR).unionByName(none.select(*PAIR)).unionByName(_wanted_pairs(spark, sf, lines))


@register
def model_paths(spark, sf):
    pages = fx.query(spark, sf, "select distinct url sku, case when page_id > 100 then 'wh ' || cast(page_id as string) end warehouse, 'c/1' customer from {pages}")
    return pages.select("sku", "warehouse", stores.object_path(F.col("customer"), F.col("warehouse"), F.col("sku")).alias("object_path"))


@register
def model_validation(spark, sf):
    return stores.check_documents(fx.documents(spark, sf)).select("id", "state")


# --- structural model and jobs


def _train(spark, sf, **options):
    return train.train_forecast(
        stored_demand(spark, sf), fx.holidays(spark, sf), as_of=fx.AS_OF, config=fx.config(spark, sf),
        promotions=fx.campaign(spark), **options,
    )


def _fitted(spark, sf, rows=None):
    rows = rows or stored_demand(spark, sf)
    pareto = routing.pareto_series(_volumes(rows))
    series = config.with_defaults(pareto.select(*SERIES))
    inputs = structural.fit_inputs(
        rows, series,
        calendar.base_holidays(fx.holidays(spark, sf)), None, campaign_daily(spark),
    )
    return structural.fit_models(inputs)


@register
def structural_fit(spark, sf):
    model = F.from_json("model_json", schemas.MODEL_BODY)
    rows = stored_demand(spark, sf)
    fitted = materialize(_fitted(spark, sf, rows)).withColumn("model", model)  # read twice: as it is, and for the proof
    prior = F.lit(float(DEFAULT_SETTINGS["prophet_changepoint_prior_scale"])).alias("prophet_changepoint_prior_scale")
    proof = fit_audit.fit_proof(rows, fitted.select(*SERIES, "model", prior), campaign_daily(spark))
    proven = (F.col("relative_gap") < 1e-4) & (F.col("relative_gap") > -1e-9) & (F.col("effect_slope") < 1e-4)
    return fitted.join(proof.select(*SERIES, proven.alias("at_minimum")), SERIES, "left").select(
        *SERIES, "error", "model.mode", "model.first_ds", "model.last_ds", "model.n_rows",
        (F.col("model.sigma") >= 0).alias("has_sigma"), F.size("model.weekly").alias("n_weekly"),
        F.size("model.regressors").alias("n_regressors"), F.size("model.change_at").alias("n_changepoints"),
        "at_minimum",
    )


@register
def structural_frame(spark, sf):
    """Days, promotion flags and order of the bounds of the forecast of fitted models."""
    rows = structural.predict(structural.parse_models(_fitted(spark, sf)), 14, campaign_daily(spark))
    ordered = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return rows.select("ds", *SERIES, "promo_flag", ordered.alias("in_order"))


@register
def model_index(spark, sf):
    return stores.model_rows(_fitted(spark, sf), fx.AS_OF).select(*SERIES, "object_path", "last_ds")


@register
def model_export(spark, sf):
    """What the store gets from a run: paths, marks and the documents' state and size."""
    rows = stores.check_documents(stores.model_rows(_fitted(spark, sf), fx.AS_OF + " 06:30:00", "nightly"))
    n_rows = F.get_json_object("model_json", "$.n_rows").cast("int")
    return rows.select(*SERIES, "object_path", "last_ds", F.col("trained_at").cast("string").alias("trained_at"), "run_id", "state", n_rows.alias("n_rows"))


# --- stored models: documents whose numbers follow from the tables, so that SQL can evaluate them


def _stored_models(spark, sf) -> DataFrame:
    return stores.newest_models(fx.model_store(spark, sf))


@register
def newest_models(spark, sf):
    """Two versions of one day: the later moment wins, or the later run id."""
    n_rows = F.get_json_object("model_json", "$.n_rows").cast("int")
    return _stored_models(spark, sf).select(*SERIES, "object_path", "last_ds", "run_id", n_rows.alias("n_rows"))


@register
def model_rejects(spark, sf):
    return stores.split_models(_stored_models(spark, sf))[1].select(*SERIES, "object_path", "run_id", "reason")


@register
def structural_forecast(spark, sf):
    good, _ = stores.split_models(_stored_models(spark, sf))
    return rounded(structural.predict(structural.parse_models(good), 14, campaign_daily(spark)))


@register
def score_models(spark, sf):
    good, _ = stores.split_models(_stored_models(spark, sf))
    return score.score_models(good, campaign_daily(spark))


@register
def score_frame(spark, sf):
    """Days and promotion flags of the scored fits; every value is a count."""
    models = stores.model_rows(_fitted(spark, sf), fx.AS_OF)
    rows = score.score_models(stores.usable_models(models), campaign_daily(spark))
    return rows.select("ds", *SERIES, "promo_flag", (F.col("yhat") >= 0).alias("is_count"))


@register
def score_promos(spark, sf):
    return score.score_promotions(_stored_models(spark, sf), fx.campaign(spark))[0]


@register
def score_status(spark, sf):
    return score.score_promotions(_stored_models(spark, sf), fx.campaign(spark))[1]


def _scored_by_customer(spark, sf):
    return score.score_promotions(_stored_models(spark, sf), fx.two_campaigns(spark), by_customer=True)


@register
def score_promos_by_customer(spark, sf):
    """Each customer's listed SKUs, flagged by their own promotions."""
    return _scored_by_customer(spark, sf)[0]


@register
def score_status_by_customer(spark, sf):
    return _scored_by_customer(spark, sf)[1]


# --- jobs: rows of drawn series are exact; of modelled series, whose fit SQL cannot do, all but the values


def _method(run) -> DataFrame:
    return run.model_series.select(*SERIES, F.lit("structural").alias("method")).distinct()


@register
def hybrid_forecast(spark, sf):
    run = _train(spark, sf)
    rows = run.forecast.join(_method(run), SERIES, "left").withColumn("method", F.coalesce("method", F.lit("poisson")))
    drawn = {c: F.when(F.col("method") == "poisson", F.col(c)) for c in post.VALUES}
    return rows.withColumns(drawn).select("ds", *SERIES, *post.VALUES, "promo_flag", "method", "segment")


@register
def hybrid_coverage(spark, sf):
    """Rows, days and order of the bounds of the whole forecast, per series."""
    rows = _train(spark, sf).forecast.groupBy(*SERIES)
    return rows.agg(
        F.count_if(F.col("segment") == "future").alias("future_days"),
        F.max("ds").alias("last_ds"),
        F.min((F.col("yhat") >= 0).cast("int")).alias("all_non_negative"),
        F.min((F.col("yhat_lower") <= F.col("yhat_upper")).cast("int")).alias("bounds_in_order"),
        F.sum("promo_flag").alias("promo_days"),
    )


@register
def train_forecast(spark, sf):
    """Published rows of a whole training run over all pairs."""
    run = _train(spark, sf)
    keys = _method(run).withColumnRenamed("customer_code", "customercode")
    rows = train.publish_rows(run).join(keys, ["customercode", "warehousecode", "Shop_SKU"], "left")
    return rows.select("ds", "customercode", "warehousecode", "Shop_SKU", F.when(F.col("method").isNull(), F.col("yhat")).alias("yhat"),
                       (F.col("yhat") >= 0).alias("is_count"))


@register
def pair_status(spark, sf):
    lines = fx.lines(spark, sf)
    pairs = _wanted_pairs(spark, sf, lines)
    return train.train_pairs(
        stored_demand(spark, sf, fx.sales(spark, sf, lines)), fx.holidays(spark, sf), pairs, as_of=fx.AS_OF, config=fx.config(spark, sf)
    )


@register
def promo_retrain_status(spark, sf):
    own = demand.collapse_warehouses(demand.filter_customer(stored_demand(spark, sf), fx.SPECIAL), "prophet")
    skus = promo.promo_skus(fx.campaign(spark))
    run = train.train_forecast(
        own, fx.holidays(spark, sf), as_of=fx.AS_OF, promotions=fx.campaign(spark), only_skus=skus
    )
    return train.retrain_status(fx.campaign(spark), fx.SPECIAL, 14, run.fitted)


@register
def customer_forecast(spark, sf):
    """One customer's listed warehouses through the whole job, models stored: the drawn series' future rows and the count of all."""
    path = f"{run_folder(spark)}/models-{uuid.uuid4()}"
    future = train.train_customer(
        stored_demand(spark, sf), fx.holidays(spark, sf), "FURNITURE", path, as_of=fx.AS_OF, warehouses=["ASIA", "EUROPE", "NOWHERE"],
    )[1]
    modelled = stores.read_models(spark, path).select(*SERIES, F.lit("structural").alias("method"))
    rows = future.join(modelled, SERIES, "left").withColumn("method", F.coalesce("method", F.lit("poisson")))
    return rows.select("ds", *SERIES, "method", F.when(F.col("method") == "poisson", F.col("yhat")).alias("yhat"))
