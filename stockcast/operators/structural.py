"""Structural model: fit per series, forecast and scoring from the stored document."""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast import PAIR, SERIES, schemas
from stockcast.functions.structural_fit import YEAR, YEARLY_ORDER, fit_series
from stockcast.operators.calendar import holiday_features
from stockcast.operators.promo import with_promo_days
from stockcast.settings import DEFAULT_SETTINGS, HOLIDAY_TOGGLES

Z80 = 1.2815515655446004  # fixed value: the normal quantile of a two-sided 80 % interval
FITTED = "customer_code STRING, warehousecode STRING, Shop_SKU STRING, model_json STRING, error STRING"
_FIT_SETTINGS = [
    "lag_days",
    "rolling_mean_windows",
    "promo_lower_window",
    "promo_upper_window",
    *[name for name in DEFAULT_SETTINGS if name.startswith("prophet_")],
]
_FEATURE_LIST = "array<struct<holiday:string,feature:string,days:array<int>>>"


def feature_list(holidays: DataFrame, by: list[str]) -> DataFrame:
    """Holiday features with the days they are active on, as one array per key. The calendar bounds it."""
    spread = holidays.select(*by, F.col("holiday").alias("_code"), "holiday", "ds", "lower_window", "upper_window")
    by_feature = (
        holiday_features(spread).groupBy(*by, "_code", "feature").agg(F.array_sort(F.collect_set(F.unix_date("ds"))).alias("days"))
    )
    entry = F.struct(F.col("_code").alias("holiday"), "feature", "days")
    return by_feature.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("features"))


def series_rows(demand: DataFrame) -> DataFrame:
    """One row per series with its days and values in order. A series has one row per calendar day."""
    points = F.array_sort(F.collect_list(F.struct(F.unix_date("ds").alias("d"), F.col("y").alias("y"))))
    return demand.groupBy(*SERIES).agg(points.alias("_p")).select(
        *SERIES, F.col("_p.d").alias("days"), F.col("_p.y").alias("y")
    )


def fit_inputs(
    demand: DataFrame,
    series: DataFrame,
    base_holidays: DataFrame,
    impact_holidays: DataFrame | None = None,
    promo_daily: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Everything the fit of a series needs, in one row, spread over `parts` tasks.

    `series` has the series to fit with their settings. The pair's impact dates are joined to its
    light rows; the long value arrays are shuffled once, by series. The calendar that all series share is added after
    the last exchange, so it never travels with them.
    """
    shared = feature_list(base_holidays.filter(F.col("holiday").isin(list(HOLIDAY_TOGGLES))), []).select("features").scalar()
    light = series.select(*SERIES, "use_promotions", *HOLIDAY_TOGGLES.values(), *_FIT_SETTINGS)
    none = F.array().cast(_FEATURE_LIST)
    impact = none
    if impact_holidays is not None:
        own = feature_list(impact_holidays, PAIR).withColumnRenamed("features", "_impact")
        light = light.join(own, PAIR, "left")
        impact = F.coalesce("_impact", none)
    promoted = F.array().cast("array<int>")
    if promo_daily is not None:
        light = with_promo_days(light, promo_daily)
        promoted = F.when(F.col("use_promotions") & F.col("_promo").isNotNull(), F.col("_promo")).otherwise(promoted)
    light = light.withColumn("promo_days", promoted).drop("_promo")
    wanted = demand.join(series.select(*SERIES), SERIES, "left_semi")
    joined = series_rows(wanted).join(light, SERIES)
    parts = parts or int(demand.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = joined.repartition(parts, *SERIES).withColumn("_base", F.coalesce(shared, none))
    enabled = F.array_compact(F.array(*[F.when(F.col(flag), code) for code, flag in HOLIDAY_TOGGLES.items()]))
    features = F.concat(F.filter("_base", lambda f: F.array_contains(enabled, f["holiday"])), impact)
    return spread.withColumn("_features", features).select(
        *SERIES,
        "days",
        "y",
        "promo_days",
        F.col("_features.feature").alias("feature_names"),
        F.col("_features.days").alias("feature_days"),
        *_FIT_SETTINGS,
    )


def _fit_batches(batches):
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            model = error = None
            try:
                settings = {name: getattr(row, name) for name in _FIT_SETTINGS}
                features = dict(zip(row.feature_names, map(np.asarray, row.feature_days)))
                model = json.dumps(fit_series(row.days, row.y, row.promo_days, features, settings))
            except Exception as problem:  # one bad series must not stop the others
                error = f"{type(problem).__name__}: {problem}"
            out.append((row.customer_code, row.warehousecode, row.Shop_SKU, model, error))
        yield pd.DataFrame(out, columns=[*SERIES, "model_json", "error"])


def fit_models(inputs: DataFrame) -> DataFrame:
    """Model document per series, or the error its fit ended with. `fit_inputs` has spread the rows."""
    return inputs.mapInPandas(_fit_batches, FITTED)


def parse_models(documents: DataFrame) -> DataFrame:
    """Model documents as structs."""
    parsed = F.from_json("model_json", schemas.MODEL_BODY).alias("model")
    return documents.filter(F.col("model_json").isNotNull()).select(*SERIES, parsed)


def _yearly(model: Column, day: Column) -> Column:
    """Yearly effect of a day number."""
    coefs, angle = model["yearly"], day * (2.0 * math.pi / YEAR)
    total = F.lit(0.0)
    for i in range(1, YEARLY_ORDER + 1):
        total = total + F.get(coefs, F.lit(2 * i - 2)) * F.sin(angle * i) + F.get(coefs, F.lit(2 * i - 1)) * F.cos(angle * i)
    return F.when(F.size(coefs) == 2 * YEARLY_ORDER, total).otherwise(0.0)


def _span(begin: Column, end: Column) -> Column:
    """begin, begin + 1, ... up to before `end`; empty if there is none."""
    return F.when(begin < end, F.sequence(begin, end - 1)).otherwise(F.array().cast("array<int>"))


def _dense(entries: Column, begin: Column, end: Column, empty: Column) -> Column:
    """One value per day from `begin` to before `end`: that of the sorted entries (day, value) in between, else `empty`.

    Built from the gaps between entries, so its cost is the days plus the entries; no day searches for its entry.
    """
    count = F.size(entries)

    def block(k):
        day = F.when(k == 0, begin - 1).otherwise(F.get(entries, k - 1)["day"])
        following = F.when(k == count, end).otherwise(F.get(entries, k)["day"])
        own = F.when(k == 0, F.slice(F.array(empty), 1, 0)).otherwise(F.array(F.get(entries, k - 1)["value"]))
        return F.concat(own, F.array_repeat(empty, following - day - 1))

    return F.flatten(F.transform(F.sequence(F.lit(0), count), block))


def _with_segments(spans: DataFrame) -> DataFrame:
    """`_segments`: the straight pieces of the trend, with the days they cover (counted from first_ds) and their two numbers."""
    bends = F.array_sort(F.transform(F.arrays_zip("model.change_at", "model.change_by"), lambda b: F.struct(b["change_at"].alias("at"), b["change_by"].alias("by"))))
    bent = spans.withColumn("_bends", F.coalesce(bends, F.array().cast("array<struct<at:double,by:double>>")))
    first, end = F.col("_begin") - F.unix_date("first_ds"), F.col("_end") - F.unix_date("first_ds")

    def place(at):  # the first whole day behind the changepoint, inside the days asked for
        return F.least(F.greatest(F.ceil(at * F.col("model.span_days")).cast("int"), first), end)

    def segment(k):
        passed = F.slice("_bends", F.lit(1), k)
        return F.struct(
            F.when(k == 0, first).otherwise(place(F.get("_bends", k - 1)["at"])).alias("begin"),
            F.when(k == F.size("_bends"), end).otherwise(place(F.get("_bends", k)["at"])).alias("end"),
            F.aggregate(passed, F.col("model.level"), lambda total, b: total - b["by"] * b["at"]).alias("level"),
            F.aggregate(passed, F.col("model.slope"), lambda total, b: total + b["by"]).alias("slope"),
        )

    return bent.withColumn("_segments", F.transform(F.sequence(F.lit(0), F.size("_bends")), segment))


def _effects(spans: DataFrame, lag_fill: str) -> DataFrame:
    """Per model the day-aligned arrays `_trend`, `_season`, `_holiday`, `_flag`, and the numbers that hold for all its days."""
    model, begin, end = F.col("model"), F.col("_begin"), F.col("_end")
    entries = F.transform(
        F.map_entries("model.holiday_effect"),
        lambda e: F.struct(F.unix_date(e["key"].cast("date")).alias("day"), e["value"].alias("value")),
    )
    inside = F.array_sort(F.filter(entries, lambda e: (e["day"] >= begin) & (e["day"] < end)))
    promoted = F.filter(F.coalesce("_promo", F.array().cast("array<int>")), lambda d: (d >= begin) & (d < end))
    listed = F.transform(promoted, lambda d: F.struct(d.alias("day"), F.lit(1).alias("value")))
    weekday = lambda d: F.get(model["weekly"], F.pmod(d + 3, F.lit(7)))  # noqa: E731  day 0 was a Thursday
    season = F.transform(_span(begin, end), lambda d: F.coalesce(weekday(d), F.lit(0.0)) + _yearly(model, d))
    lines = F.transform("_segments", lambda g: F.transform(_span(g["begin"], g["end"]), lambda x: g["level"] + g["slope"] * (x / model["span_days"])))

    def share(value):
        """Sum of the regressors' effects, where `value` is the promotion flag."""
        lag = (lambda r: r["last"]) if lag_fill == "last" else (lambda r: F.lit(0.0))
        own = lambda r: F.when(r["name"] == "promo_flag", F.lit(value)).otherwise(lag(r))
        return F.aggregate(model["regressors"], F.lit(0.0), lambda total, r: total + r["coef"] * (own(r) - r["center"]) / r["scale"])

    none = F.struct(F.lit(0).alias("day"), F.lit(0.0).alias("value"))
    return spans.withColumn("_inside", F.coalesce(inside, F.slice(F.array(none), 1, 0))).withColumn("_listed", listed).withColumns(
        {
            "_trend": F.flatten(lines),
            "_season": season,
            "_holiday": _dense(F.col("_inside"), begin, end, F.lit(0.0)),
            "_flag": _dense(F.col("_listed"), begin, end, F.lit(0)),
            "_off": share(0.0),
            "_on": share(1.0),
            "_many": model["mode"] == "multiplicative",
            "_scale": model["y_scale"],
            "_noise": model["sigma"] * model["sigma"],
            "_span_days": model["span_days"],
            "_bend_rate": _bend_rate(model),
        }
    )


def aligned_effects(spans: DataFrame) -> DataFrame:
    """`_trend`, `_season`, `_holiday`, `_flag` of each row's `model` from the day `_begin` to before `_end` (day numbers), as arrays."""
    return _effects(_with_segments(spans), "last")


def _bend_rate(model: Column) -> Column:
    """What the variance of the trend grows by with the third power of the time ahead.

    As published, changepoints go on as often as in the history (their number per unit of time), each by a Laplace
    draw whose scale is their mean size. A bend of variance 2 * scale**2 at time s moves the trend by its size times
    (t - s), so the sum over a Poisson stream has the variance count * 2 * scale**2 * h**3 / 3 at the time h ahead.
    """
    count = F.size(model["change_by"])
    total = F.aggregate(model["change_by"], F.lit(0.0), lambda total, by: total + F.abs(by))
    return F.when(count > 0, 2.0 * total * total / count / 3.0).otherwise(0.0)


def predict(
    models: DataFrame,
    periods: int,
    promo_daily: DataFrame | None = None,
    include_history: bool = True,
    lag_fill: str = "last",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Forecast of each model's days, all in JVM expressions.

    Each model makes its trend, its seasonal and holiday effects and its promotion flags as arrays aligned by day; what is
    exploded are their values, so no row of the forecast carries a model, a map or an array. Training fills the lags of every day with the last
    known values ('last'), scoring with 0 ('zero'). A `periods` column of the models wins over the parameter; columns in
    `keep` are carried on. The bounds hold 80 %: noise, and behind the training data the uncertainty of the trend.
    """
    if lag_fill not in ("last", "zero"):
        raise ValueError("lag_fill is 'last' or 'zero'")
    ahead = F.col("periods") if "periods" in models.columns else F.lit(periods)
    spans = models.withColumns(
        {
            "first_ds": F.col("model.first_ds").cast("date"),
            "last_ds": F.col("model.last_ds").cast("date"),
        }
    )
    if promo_daily is None:
        spans = spans.withColumn("_promo", F.lit(None).cast("array<int>"))
    else:  # joined per model, so that no shuffle ever moves a model once per day
        spans = with_promo_days(spans, promo_daily)
        if "use_promotions" in models.columns:
            spans = spans.withColumn("_promo", F.when(F.col("use_promotions"), F.col("_promo")))
    spans = spans.withColumns(
        {
            "_begin": F.unix_date("first_ds") if include_history else F.unix_date("last_ds") + 1,
            "_end": F.unix_date("last_ds") + 1 + ahead.cast("int"),
        }
    ).filter(F.col("_begin") < F.col("_end"))
    aligned = _effects(_with_segments(spans), lag_fill).select(
        *SERIES, *keep, "_off", "_on", "_many", "_scale", "_noise", "_span_days", "_bend_rate", "first_ds",
        F.inline(F.arrays_zip(_span(F.col("_begin"), F.col("_end")).alias("day"), "_trend", "_season", "_holiday", "_flag")),
    )
    effect = F.col("_season") + F.col("_holiday") + F.when(F.col("_flag") == 1, F.col("_on")).otherwise(F.col("_off"))
    factor = F.when(F.col("_many"), 1.0 + F.col("_effect")).otherwise(1.0)
    beyond = F.greatest((F.col("day") - F.unix_date("first_ds")) / F.col("_span_days") - 1.0, F.lit(0.0))
    spread = F.sqrt(F.col("_noise") + factor * factor * F.col("_bend_rate") * beyond * beyond * beyond)
    yhat = F.when(F.col("_many"), F.col("_trend") * (1.0 + F.col("_effect"))).otherwise(F.col("_trend") + F.col("_effect"))
    valued = aligned.withColumn("_effect", effect).select(
        F.date_from_unix_date("day").alias("ds"), *SERIES, F.col("_flag").alias("promo_flag"),
        (yhat * F.col("_scale")).alias("yhat"), (F.lit(Z80) * spread * F.col("_scale")).alias("_margin"), *keep,
    )
    low, high = F.col("yhat") - F.col("_margin"), F.col("yhat") + F.col("_margin")
    return valued.select(
        "ds", *SERIES, "yhat", low.alias("yhat_lower"), high.alias("yhat_upper"), "promo_flag", *keep
    )
