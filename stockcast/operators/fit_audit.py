"""Proof of a stored fit, from the document and the demand alone: nothing that the fit says about itself is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast import SERIES
from stockcast.functions.structural_fit import REGRESSOR_PRIOR, TREND_PRIOR
from stockcast.operators.promo import with_promo_days
from stockcast.operators.structural import aligned_effects, series_rows


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _history(name: Column, at: Column) -> Column:
    """A lag or moving mean of the rows before row `at` (from 0) of the series."""
    rows = F.regexp_extract(name, "([0-9]+)$", 1).try_cast("int")
    before = F.aggregate(F.slice("y", at - rows + 1, rows), F.lit(0.0), lambda total, y: total + y) / rows
    return F.when(name.startswith("y_lag"), F.get(F.col("y"), at - rows)).otherwise(before)


def fit_proof(demand: DataFrame, models: DataFrame, promo_daily: DataFrame | None = None) -> DataFrame:
    """SERIES, relative_gap, effect_slope of each model (`model`, and the setting `prophet_changepoint_prior_scale`).

    `relative_gap` bounds how far the trend's penalised sum lies above its minimum, given the effects, as a share of that
    sum: the residuals, scaled until no changepoint's slope exceeds its penalty, are a point of the dual problem, whose value
    is at most the minimum. `effect_slope` is the largest slope of the sum by a regressor, per row, given the trend.
    A series has one row per calendar day; one row per series holds its days as arrays, so the demand is exchanged once.
    """
    rows = series_rows(demand.join(models.select(*SERIES), SERIES, "left_semi")).join(models, SERIES)
    rows = with_promo_days(rows, promo_daily) if promo_daily is not None else rows.withColumn("_promo", F.lit(None).cast("array<int>"))
    model = F.col("model")
    spans = rows.withColumns({
        "first_ds": model["first_ds"].cast("date"),
        "_skip": F.size("days") - model["n_rows"],
        "_begin": F.unix_date(model["first_ds"].cast("date")),
        "_end": F.unix_date(model["last_ds"].cast("date")) + 1,
    })
    at = F.sequence(F.lit(0), model["n_rows"] - 1)

    def values(r):
        plain = lambda i: F.when(r["name"] == "promo_flag", F.get("_flag", i).cast("double")).otherwise(_history(r["name"], i + F.col("_skip")))
        return F.transform("_at", lambda i: (plain(i) - r["center"]) / r["scale"])

    many = model["mode"] == "multiplicative"
    daily = aligned_effects(spans).withColumn("_at", at).withColumn("_x", F.transform(model["regressors"], values))
    daily = daily.withColumn("_effect", F.transform("_at", lambda i: F.get("_season", i) + F.get("_holiday", i) + F.aggregate(
        F.zip_with("_x", model["regressors"], lambda x, r: F.get(x, i) * r["coef"]), F.lit(0.0), lambda total, v: total + v)))
    daily = daily.withColumns({
        "_y": F.transform("_at", lambda i: F.get("y", i + F.col("_skip")) / model["y_scale"]),
        "_t": F.transform("_at", lambda i: i / model["span_days"]),
        "_factor": F.transform("_effect", lambda e: F.when(many, 1.0 + e).otherwise(1.0)),
    })
    daily = daily.withColumns({
        "_target": F.zip_with("_y", "_effect", lambda y, e: F.when(many, y).otherwise(y - e)),
        "_rest": F.transform("_at", lambda i: F.get("_y", i) - F.when(many, F.get("_trend", i) * F.get("_factor", i)).otherwise(
            F.get("_trend", i) + F.get("_effect", i))),
    })
    daily = daily.withColumn("_pull", F.zip_with("_rest", "_factor", lambda r, f: r * f))
    sums = daily.withColumns({
        "_square": _dot(F.col("_rest"), F.col("_rest")),
        "_along": _dot(F.col("_target"), F.col("_rest")),
        "_by_slope": _dot(F.col("_t"), F.col("_pull")),
        "_by_level": F.aggregate("_pull", F.lit(0.0), lambda total, p: total + p),
        "_by_change": F.transform(model["change_at"], lambda s: _dot(F.transform("_t", lambda t: F.greatest(t - s, F.lit(0.0))), F.col("_pull"))),
        "_by_effect": F.zip_with("_x", model["regressors"], lambda x, r: F.abs(
            _dot(x, F.zip_with("_rest", "_trend", lambda e, g: e * F.when(many, g).otherwise(1.0)))
            - r["coef"] * model["sigma"] * model["sigma"] / REGRESSOR_PRIOR**2)),
    })
    noise = F.greatest(model["sigma"] * model["sigma"], F.lit(1e-8))
    ridge, bound = noise / TREND_PRIOR**2, noise / F.col("prophet_changepoint_prior_scale")
    steepest = F.coalesce(F.array_max(F.transform("_by_change", F.abs)), F.lit(0.0))
    bends = F.aggregate(model["change_by"], F.lit(0.0), lambda total, b: total + F.abs(b))
    share = F.when(steepest > bound, bound / steepest).otherwise(1.0)
    primal = F.col("_square") / 2 + ridge * (model["slope"] * model["slope"] + model["level"] * model["level"]) / 2 + bound * bends
    straight = (F.col("_by_slope") * F.col("_by_slope") + F.col("_by_level") * F.col("_by_level")) / ridge
    dual = share * F.col("_along") - share * share * (F.col("_square") + straight) / 2
    return sums.select(
        *SERIES, ((primal - dual) / primal).alias("relative_gap"), (F.array_max("_by_effect") / model["n_rows"]).alias("effect_slope")
    )
