"""Per-series features. Windows run over one series, which holds at most one row per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockcast import PAIR, SERIES
from stockcast.settings import DEFAULT_SETTINGS

LAGS = DEFAULT_SETTINGS["lag_days"]
ROLLING = DEFAULT_SETTINGS["rolling_mean_windows"]


def feature_names(lags: list[int] = LAGS, rolling: list[int] = ROLLING) -> list[str]:
    return [f"y_lag{n}" for n in lags] + [f"rolling_mean_{n}" for n in rolling]


def lag_features(demand: DataFrame, lags: list[int] = LAGS, rolling: list[int] = ROLLING) -> DataFrame:
    """Demand n rows back, and the mean of the n rows before the current one."""
    in_order = Window.partitionBy(*SERIES).orderBy("ds")
    added = {f"y_lag{n}": F.lag("y", n).over(in_order) for n in lags}
    for n in rolling:
        before = in_order.rowsBetween(-n, -1)
        added[f"rolling_mean_{n}"] = F.when(F.count("y").over(before) == n, F.avg("y").over(before))
    return demand.withColumns(added)


def promo_regressor(rows: DataFrame, promo_daily: DataFrame | None) -> DataFrame:
    """Add promo_flag: 1 on the SKU's promotion days, else 0."""
    if promo_daily is None:
        return rows.withColumn("promo_flag", F.lit(0))
    keys = [k for k in [*PAIR, "Shop_SKU", "ds"] if k in promo_daily.columns]
    flags = promo_daily.select(*keys, F.col("promo_flag").alias("_flag"))
    flag = F.coalesce("_flag", F.lit(0)).cast("int")
    return rows.join(flags, keys, "left").select(*rows.columns, flag.alias("promo_flag"))


def series_features(
    demand: DataFrame, promo_daily: DataFrame | None, lags: list[int] = LAGS, rolling: list[int] = ROLLING
) -> DataFrame:
    """Lags, rolling means and promo flag; rows without a full history drop out."""
    return promo_regressor(lag_features(demand, lags, rolling).dropna(subset=feature_names(lags, rolling)), promo_daily)


def last_known_features(features: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Latest value of each feature per series."""
    names = names or feature_names()
    latest = F.max_by(F.struct(*names), F.col("ds"))
    return features.groupBy(*SERIES).agg(latest.alias("_last")).select(*SERIES, "_last.*")


def promo_days_in_train(features: DataFrame) -> DataFrame:
    return features.groupBy(*SERIES).agg(F.sum("promo_flag").alias("promo_days"))


def future_days(spans: DataFrame, periods: int, include_history: bool = True) -> DataFrame:
    """One row per series and day to predict.

    `spans` has first_ds and last_ds per series; an own `periods` column, if any, wins over the
    parameter.
    """
    ahead = F.col("periods") if "periods" in spans.columns else F.lit(periods)
    begin = F.col("first_ds") if include_history else F.date_add("last_ds", 1)
    end = F.date_add(F.col("last_ds"), ahead.cast("int"))
    return spans.filter(begin <= end).select("*", F.explode(F.sequence(begin, end)).alias("ds"))


def future_frame(
    spans: DataFrame, periods: int, promo_daily: DataFrame | None, include_history: bool = True
) -> DataFrame:
    """Days to predict per series, with their promo flag."""
    return promo_regressor(future_days(spans, periods, include_history), promo_daily)
