"""Jobs: train and forecast all pairs of a run in one plan, store models, publish, report."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast import PAIR, SERIES
from stockcast.operators import calendar, config as settings_table, demand as cuts, post, promo, routing
from stockcast.operators.demand import filter_scope
from stockcast.operators.impact import impact_dates, top_demand, top_series
from stockcast.operators.poisson import bad_rates, poisson_forecast
from stockcast.operators.structural import fit_inputs, fit_models, parse_models, predict
from stockcast.session import materialize
from stockcast.settings import (
    BIAS_MIN_DAYS,
    BIAS_MIN_DEMAND,
    DEFAULT_SETTINGS,
    PERIODS,
    SEED,
    TEST_DAYS,
    ZSCORE_RULES,
)
from stockcast.sources import stores


@dataclass
class Training:
    """What a training run yields; every table is lazy and covers all pairs."""

    settings: DataFrame
    train: DataFrame
    test: DataFrame
    pareto: DataFrame
    impact_dates: DataFrame
    holidays: DataFrame
    promo_daily: DataFrame | None
    model_series: DataFrame
    fitted: DataFrame
    errors: DataFrame
    forecast: DataFrame
    forecast_future: DataFrame
    forecast_past: DataFrame
    promo_inspect: DataFrame | None
    promo_summary: DataFrame | None
    validation: DataFrame


#: series of one fitting or drawing task at most, so that the tasks grow with the series
SERIES_PER_TASK = 256


def run_settings(pairs: DataFrame, config: DataFrame | None, override: Mapping | None) -> DataFrame:
    """Effective settings per pair, from the request, the config table and the built-in values."""
    found = pairs if config is None else settings_table.lookup_config(pairs, config)
    return settings_table.effective_config(found, settings_table.flatten_override(override))


def _tasks(rows: DataFrame) -> int:
    """Tasks for the rows of a written table with one row per series."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows.count() // SERIES_PER_TASK))


def _run_series(
    stats: DataFrame,
    validation: DataFrame,
    as_of: str,
    periods: int,
    config: DataFrame | None,
    override: Mapping | None,
) -> DataFrame:
    """The series of valid pairs, each with its pair's last day, horizon and settings."""
    valid = validation.filter(F.col("reason").isNull()).select(*PAIR)
    late = cuts.missing_days(stats.withColumnRenamed("last_ds", "ds"), as_of).select(
        *PAIR, F.col("last_ds").alias("latest_date"), (F.lit(periods) + F.col("dif_days")).alias("periods")
    )
    pairs = valid.join(late, PAIR).join(run_settings(valid, config, override), PAIR)
    return cuts.train_volume(stats.join(pairs, PAIR))


def train_forecast(
    demand: DataFrame,
    holidays: DataFrame,
    *,
    as_of: str,
    promotions: DataFrame | None = None,
    config: DataFrame | None = None,
    override: Mapping | None = None,
    pairs: DataFrame | None = None,
    only_skus: DataFrame | None = None,
    periods: int = PERIODS,
    test_days: int | None = None,
    bias_min_demand: float = BIAS_MIN_DEMAND,
    bias_min_days: int = BIAS_MIN_DAYS,
    rules: list[tuple[int, float]] | None = None,
    promo_by_customer: bool = False,
    seed: int = SEED,
) -> Training:
    """Train and forecast every pair of the demand at once.

    Pairs that fail validation (see `validation`) take no part. Fits run once: the model documents
    are written down before the forecasts, reports and the model store read them. `test_days` and `rules` default to
    those of the request (`override`), then to the built-in ones. With `promo_by_customer` a promotion counts for the
    customer it names only.
    """
    request = settings_table.flatten_override(override)
    test_days = test_days if test_days is not None else request.get("test_days", TEST_DAYS)
    rules = rules or request.get("zscore_rules", ZSCORE_RULES)
    if pairs is not None:
        demand = filter_scope(demand, pairs)
    # one row per series from here on; the demand is read again only for a few series or days
    stats = materialize(cuts.series_stats(demand))
    validation = cuts.validate_inputs(stats, holidays)
    series = materialize(_run_series(stats, validation, as_of, periods, config, override))
    settings = series.groupBy(*PAIR).agg(*[F.any_value(n).alias(n) for n in DEFAULT_SETTINGS])

    base = calendar.base_holidays(holidays)
    train, test = cuts.train_split(demand, series), cuts.test_split(demand, test_days, series)
    top = materialize(top_series(series))
    windows = settings.select(*PAIR, "impact_lower_window", "impact_upper_window")
    # the top series bring their pair's last day along: they alone are cut and windowed
    recent = top_demand(demand, top)
    impact_days = materialize(calendar.impact_holidays(impact_dates(recent, top, rules).join(windows, PAIR)))
    all_holidays = calendar.with_impact(calendar.toggle_holidays(base, settings), impact_days)

    daily = None
    if promotions is not None:
        master = promo.promo_master_valid(promo.promo_master(promotions))
        daily = promo.promo_daily(master, series.select("customer_code", "Shop_SKU"), promo_by_customer)
        if only_skus is not None:
            daily = routing.override_series(daily, only_skus)
        daily = materialize(daily)

    pareto = routing.pareto_series(series.select(*SERIES, "volume"))
    if only_skus is not None:
        series, train, test = (routing.override_series(part, only_skus) for part in (series, train, test))
        chosen = series.select(*SERIES)
    else:
        chosen = routing.model_series(pareto, series.filter("use_promotions"), daily)
    routed = materialize(routing.route(series, chosen))
    modelled_series = routed.filter(F.col("method") == "structural")
    fitted = materialize(fit_models(fit_inputs(demand, modelled_series, base, impact_days, daily, _tasks(modelled_series))))

    extra = modelled_series.select(*SERIES, "periods", "latest_date", "use_promotions")
    carried = ("latest_date", "use_promotions")
    modelled = predict(parse_models(fitted).join(extra, SERIES), periods, daily, keep=carried)
    spans = routed.filter(F.col("method") == "poisson")
    drawn = poisson_forecast(spans, periods, seed, carried, daily, _tasks(spans))
    if daily is None:
        drawn = drawn.withColumn("promo_flag", F.lit(0))
    # every row got its flag from its series' array of days; no join of forecast rows is needed for it
    flag = F.when(F.col("use_promotions"), F.col("promo_flag")).otherwise(0).alias("promo_flag")
    cleaned = post.int_cleanup(modelled.unionByName(drawn)).withColumn("promo_flag", flag)
    forecast = post.production_window(cleaned, as_of)
    if bias_min_days <= test_days:  # a series has one row per day, so else none has enough test days for a correction
        forecast = materialize(forecast)
        past = forecast.filter(F.col("segment") == "past")
        corrected = post.apply_bias(forecast, post.bias_correction(test, past, bias_min_demand, bias_min_days))
        forecast = post.int_cleanup(corrected)
    flagged = forecast
    forecast = flagged.drop("use_promotions")
    errors = fitted.select(*SERIES, "error").filter(F.col("error").isNotNull()).unionByName(bad_rates(spans))
    promoting = flagged.filter("use_promotions").drop("use_promotions")
    return Training(
        settings=settings,
        train=train,
        test=test,
        pareto=pareto,
        impact_dates=impact_days.select(*PAIR, "ds"),
        holidays=all_holidays,
        promo_daily=daily,
        model_series=chosen,
        fitted=fitted,
        errors=errors,
        forecast=forecast,
        forecast_future=forecast.filter(F.col("segment") == "future"),
        forecast_past=forecast.filter(F.col("segment") == "past"),
        promo_inspect=None if daily is None else promo.promo_inspect(promoting, daily),
        promo_summary=None if daily is None else promo.promo_summary(promoting, daily),
        validation=validation,
    )


def train_and_store(
    demand: DataFrame,
    holidays: DataFrame,
    model_path: str,
    *,
    as_of: str,
    promotions: DataFrame | None = None,
    promo_only: bool = True,
    run_at: str | None = None,
    run_id: str | None = None,
    **options,
) -> Training:
    """Train, then add the model documents to the store. `promo_only` restricts to promoted SKUs.

    `run_at` is the moment of the run (now, if not given): the later run's document wins, also on one day.
    """
    skus = None
    if promo_only:
        if promotions is None:
            raise ValueError("promo_only needs promotions")
        skus = promo.promo_skus(promotions)
        if skus.isEmpty():
            raise ValueError("no SKU is listed in the promotions")
    run = train_forecast(demand, holidays, as_of=as_of, promotions=promotions, only_skus=skus, **options)
    store_models(run, model_path, run_at, run_id)
    return run


def store_models(run: Training, model_path: str, run_at: str | None = None, run_id: str | None = None) -> None:
    """Add a run's documents to the store, marked with the moment and id of the run."""
    moment = run_at or datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")
    stores.write_models(stores.model_rows(run.fitted, moment, run_id or uuid.uuid4().hex), model_path)


def retrain_promoted(
    demand: DataFrame, holidays: DataFrame, promotions: DataFrame, model_path: str, *, as_of: str, customer_code: str, **options
) -> DataFrame:
    """Retrain one customer's promoted SKUs; the result is one status row per SKU."""
    own = cuts.collapse_warehouses(cuts.filter_customer(demand, customer_code), "prophet")
    run = train_and_store(own, holidays, model_path, as_of=as_of, promotions=promotions, **options)
    return retrain_status(promotions, customer_code, options.get("periods", PERIODS), run.fitted)


def retrain_status(
    promotions: DataFrame, customer_code: str, periods: int, fitted: DataFrame | None = None
) -> DataFrame:
    """Status of a promotion retrain: each promoted SKU and whether its model was stored."""
    work = promo.promo_worklist(promotions, customer_code, periods)
    if fitted is None:
        return work.withColumn("status", F.lit("uploaded"))
    state = F.when(F.col("error").isNull(), "uploaded").otherwise("failed").alias("_state")
    done = fitted.select("Shop_SKU", state)
    return work.join(done, "Shop_SKU", "left").select(
        "customer_code", "Shop_SKU", "periods", F.coalesce("_state", F.lit("no demand")).alias("status")
    )


def train_customer(
    demand: DataFrame,
    holidays: DataFrame,
    customer_code: str,
    model_path: str,
    *,
    as_of: str,
    warehouses: list[str] | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """All or the listed warehouses of one customer: the whole and the future forecast.

    A warehouse that cannot be trained, or of which a fit failed, is left out.
    """
    own = cuts.filter_customer(demand, customer_code)
    if warehouses is not None:
        own = own.filter(F.col("warehousecode").isin(warehouses))
    run = train_and_store(own, holidays, model_path, as_of=as_of, promo_only=False, **options)
    return tuple(rows.join(failed_pairs(run.errors), PAIR, "left_anti") for rows in (run.forecast, run.forecast_future))


def failed_pairs(errors: DataFrame) -> DataFrame:
    return errors.filter(F.col("error").isNotNull()).select(*PAIR).distinct()


def pair_status(pairs: DataFrame, validation: DataFrame, errors: DataFrame, upload: DataFrame) -> DataFrame:
    """One row per requested pair: published, skipped as empty, or failed and why."""
    failed = (
        errors.filter(F.col("error").isNotNull()).groupBy(*PAIR).agg(F.min("error").alias("_fit_error"))
    )
    shipped = upload.groupBy(
        F.col("customercode").alias("customer_code"), "warehousecode"
    ).agg(F.count(F.lit(1)).alias("n_rows"))
    joined = (
        pairs.select(*PAIR)
        .distinct()
        .join(validation.select(*PAIR, "reason", F.lit(True).alias("_seen")), PAIR, "left")
        .join(failed, PAIR, "left")
        .join(shipped, PAIR, "left")
    )
    unknown = F.when(F.col("_seen").isNull(), "no demand")
    error = F.coalesce("reason", "_fit_error", unknown)
    skipped = error.isNull() & F.col("n_rows").isNull()
    return joined.select(
        F.col("customer_code").alias("customercode"),
        "warehousecode",
        error.isNull().alias("ok"),
        skipped.alias("skipped"),
        F.when(skipped, "empty_upload").alias("reason"),
        error.alias("error"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )


def publish_rows(run: Training) -> DataFrame:
    """Future forecast in its published shape; a pair with a failed fit keeps its old rows."""
    return post.output_shape(run.forecast_future.join(failed_pairs(run.errors), PAIR, "left_anti"))


def train_pairs(
    demand: DataFrame,
    holidays: DataFrame,
    pairs: DataFrame,
    *,
    as_of: str,
    model_path: str | None = None,
    publish_path: str | None = None,
    run_at: str | None = None,
    run_id: str | None = None,
    **options,
) -> DataFrame:
    """Train and publish the pairs of a run; the result is one status row per pair."""
    pairs = materialize(pairs.select(*PAIR).distinct())  # its known size decides how the demand is cut
    run = train_forecast(demand, holidays, as_of=as_of, pairs=pairs, **options)
    upload = materialize(publish_rows(run))
    if model_path:
        store_models(run, model_path, run_at, run_id)
    if publish_path:
        stores.replace_published(upload, publish_path)
    return pair_status(pairs, run.validation, run.errors, upload)


