"""From forecasts to published rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast import SERIES
from stockcast.functions.columns import half_even, non_negative_int, strip, truncated_int
from stockcast.session import materialize
from stockcast.settings import BIAS_MIN_DAYS, BIAS_MIN_DEMAND, PRODUCTION_DAYS

VALUES = ["yhat", "yhat_lower", "yhat_upper"]


def int_cleanup(forecast: DataFrame) -> DataFrame:
    present = [c for c in VALUES if c in forecast.columns]
    return forecast.withColumns({c: non_negative_int(F.col(c)) for c in present})


def bias_correction(
    actual: DataFrame,
    forecast: DataFrame,
    min_demand: float = BIAS_MIN_DEMAND,
    min_days: int = BIAS_MIN_DAYS,
) -> DataFrame:
    """Median shortfall per series over the days both sides have; 0 for small or seldom short ones."""
    both = actual.select(*SERIES, "ds", "y").join(forecast.select(*SERIES, "ds", "yhat"), [*SERIES, "ds"])
    short = F.when(F.col("y") > F.col("yhat"), F.col("y") - F.col("yhat"))
    totals = both.groupBy(*SERIES).agg(
        F.sum("y").alias("_demand"), F.count(short).alias("_days"), F.median(short).alias("_median")
    )
    enough = (F.col("_demand") >= min_demand) & (F.col("_days") >= min_days)
    correction = F.when(enough, F.coalesce("_median", F.lit(0.0))).otherwise(0.0)
    return totals.select(*SERIES, correction.alias("correction"))


def apply_bias(forecast: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrected yhat as integer; the interval stays as it is."""
    joined = forecast.join(corrections, SERIES, "left")
    corrected = half_even(F.col("yhat") + F.coalesce("correction", F.lit(0.0)))
    return joined.withColumn("yhat", corrected).select(*forecast.columns)


def production_window(forecast: DataFrame, as_of: str, days: int = PRODUCTION_DAYS) -> DataFrame:
    """History, and the `days` days from `as_of` on. Rows carry their pair's latest_date."""
    start = F.lit(as_of).cast("date")
    past = F.col("ds") <= F.col("latest_date")
    ahead = F.col("ds").between(start, F.date_add(start, days - 1))
    kept = forecast.filter(past | ahead)
    return kept.withColumn("segment", F.when(past, "past").otherwise("future"))


def forecast_promo_flag(forecast: DataFrame, promo_daily: DataFrame | None) -> DataFrame:
    """Forecast rows with the promotion flag of their SKU and day."""
    if promo_daily is None:
        return forecast.withColumn("promo_flag", F.lit(0))
    keys = [k for k in ("ds", "customer_code", "Shop_SKU") if k in promo_daily.columns]
    flags = promo_daily.select(*keys, F.col("promo_flag").alias("_flag"))
    flag = F.coalesce("_flag", F.lit(0)).cast("int")
    return forecast.join(flags, keys, "left").select(*forecast.columns, flag.alias("promo_flag"))


# Other names a forecast's columns may come with.
_ALIASES = {
    "customer_code": "customercode",
    "warehouse_code": "warehousecode",
    "shop_sku": "Shop_SKU",
    "ShopSKU": "Shop_SKU",
}


def output_shape(forecast: DataFrame) -> DataFrame:
    """The published columns in order. Numbers are cut to integers; rows without a date drop out."""
    names = [_ALIASES.get(c, c) for c in forecast.columns]
    named = forecast.toDF(*names)
    for required in ("customercode", "Shop_SKU", "ds", "yhat"):
        if required not in names:
            raise KeyError(f"the forecast has no column {required}")
    warehouse = F.col("warehousecode") if "warehousecode" in names else F.lit(None)
    return named.select(
        F.col("ds").try_cast("timestamp").alias("ds"),
        "customercode",
        warehouse.cast("string").alias("warehousecode"),
        "Shop_SKU",
        truncated_int(F.col("yhat")).alias("yhat"),
    ).dropna(subset=["ds"])


def scoped_replace(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """The published table after a run: the run's pairs anew, all other pairs as before.

    The batch is written down first, as its rows and its pairs are both read.
    """
    new = materialize(published_rows(batch))
    pairs = new.select("customercode", "warehousecode").distinct()
    same = existing["customercode"].eqNullSafe(pairs["customercode"]) & existing["warehousecode"].eqNullSafe(
        pairs["warehousecode"]
    )
    return existing.join(pairs, same, "left_anti").select(*new.columns).unionByName(new)


def published_rows(batch: DataFrame) -> DataFrame:
    """Rows as they are stored: trimmed codes, and no warehouse rather than a blank one."""
    warehouse = strip(F.col("warehousecode"))
    return batch.select(
        "ds",
        strip(F.col("customercode")).alias("customercode"),
        F.when(warehouse != "", warehouse).alias("warehousecode"),
        "Shop_SKU",
        "yhat",
    )
