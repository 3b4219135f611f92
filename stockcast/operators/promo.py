"""Promotions: from nested documents to daily flags, and the reports on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast import PAIR
from stockcast.functions.columns import day

_BASE = ["customer_code", "promotion_name", "promotion_code", "start_date", "end_date"]


def _mode():
    return F.upper(F.coalesce("apply_mode", F.lit("ALL")))


def promo_master(promotions: DataFrame) -> DataFrame:
    """One row per promotion and SKU; a promotion on everything has one row without SKU.

    An unknown mode fails the query.
    """
    whole = F.struct(
        F.lit(None).cast("string").alias("sku_code"),
        F.col("discount.amount").alias("discount_amount"),
        F.col("discount.type").alias("discount_type"),
    )
    listed = F.transform(
        F.coalesce("include_sku", F.array().cast("array<struct<sku_code:string,discount_amount:double,discount_type:string>>")),
        lambda s: F.struct(
            s["sku_code"].alias("sku_code"),
            s["discount_amount"].alias("discount_amount"),
            s["discount_type"].alias("discount_type"),
        ),
    )
    entries = (
        F.when(_mode() == "ALL", F.array(whole))
        .when(_mode() == "INCLUDE", listed)
        .otherwise(F.raise_error(F.concat(F.lit("Unknown apply_mode: "), _mode())))
    )
    return promotions.select(
        *_BASE, _mode().alias("apply_mode"), F.inline(entries)
    ).withColumn("discount_type", F.lower(F.coalesce("discount_type", F.lit(""))))


def promo_master_valid(master: DataFrame) -> DataFrame:
    """Mode, dates and SKU of the promotions whose dates parse and run forward."""
    dated = master.select(
        *[c for c in ("customer_code",) if c in master.columns],
        "apply_mode",
        day(F.col("start_date")).alias("start_date"),
        day(F.col("end_date")).alias("end_date"),
        "sku_code",
    )
    return dated.filter(F.col("end_date") >= F.col("start_date"))


def promo_daily(valid: DataFrame, skus: DataFrame | None, by_customer: bool = False) -> DataFrame:
    """Promoted days of each SKU, once each; with `by_customer` of each customer's SKU, so that a promotion counts for its
    own customer only.

    Days of promotions on everything are first gathered into one sorted array (per customer), which the calendar
    bounds, and then laid out per SKU: neither the promotions nor a hot SKU multiply.
    """
    key = ["customer_code"] if by_customer else []
    days = F.explode(F.sequence("start_date", "end_date")).alias("ds")
    listed = (
        valid.filter((F.col("apply_mode") != "ALL") & F.col("sku_code").isNotNull())
        .select(*key, F.col("sku_code").alias("Shop_SKU"), "start_date", "end_date")
        .distinct()
        .select(days, *key, "Shop_SKU")
    )
    whole = valid.filter(F.col("apply_mode") == "ALL").select(*key, "start_date", "end_date").distinct()
    if skus is None:
        if not whole.isEmpty():
            raise ValueError("a promotion applies to all SKUs, but no SKU list was given")
        return _flagged(listed, key)
    gathered = F.array_sort(F.collect_set("ds"))
    own = skus.select(*key, "Shop_SKU").distinct()
    if by_customer:
        by_key = whole.select(days, *key).groupBy(*key).agg(gathered.alias("_days"))
        everything = own.join(by_key, key).select(F.explode("_days").alias("ds"), *key, "Shop_SKU")
    else:
        everything = own.select(F.explode(whole.select(days).agg(gathered).scalar()).alias("ds"), "Shop_SKU")
    return _flagged(listed.unionByName(everything), key)


def _flagged(days: DataFrame, key: list[str]) -> DataFrame:
    return days.groupBy("ds", *key, "Shop_SKU").agg(F.max(F.lit(1)).alias("promo_flag"))


def _keys(daily: DataFrame) -> list[str]:
    """What a promotion's days belong to: the SKU, or the customer's SKU."""
    return [k for k in ("customer_code", "Shop_SKU") if k in daily.columns]


def with_promo_days(rows: DataFrame, daily: DataFrame) -> DataFrame:
    """Add the promoted days of each row's SKU as one sorted array `_promo`, which the calendar bounds; null without any."""
    keys = _keys(daily)
    days = daily.groupBy(*keys).agg(F.array_sort(F.collect_set(F.unix_date("ds"))).alias("_promo"))
    return rows.join(days, keys, "left")


def promo_skus(promotions: DataFrame, by_customer: bool = False) -> DataFrame:
    """Distinct SKU codes listed in any promotion, whatever its mode; with `by_customer` those of each customer."""
    key = ["customer_code"] if by_customer else []
    codes = promotions.select(*key, F.explode("include_sku.sku_code").alias("Shop_SKU"))
    return codes.filter(F.col("Shop_SKU") != "").distinct()


def promo_worklist(promotions: DataFrame, customer_code: str, periods: int) -> DataFrame:
    """One scoring task per promoted SKU."""
    return promo_skus(promotions).select(
        F.lit(customer_code).alias("customer_code"), "Shop_SKU", F.lit(periods).alias("periods")
    )


def promo_window(daily: DataFrame) -> DataFrame:
    """First and last promoted day and the number of promoted SKUs."""
    active = daily.filter(F.col("promo_flag") == 1)
    return active.agg(
        F.min("ds").alias("promo_start"),
        F.max("ds").alias("promo_end"),
        F.countDistinct("Shop_SKU").alias("n_promo_skus"),
    )


def _promoted_rows(forecast: DataFrame, daily: DataFrame) -> DataFrame:
    skus = daily.filter(F.col("promo_flag") == 1).select(*_keys(daily)).distinct()
    return forecast.join(skus, _keys(daily), "left_semi").select(*forecast.columns)


def promo_inspect(forecast: DataFrame, daily: DataFrame) -> DataFrame:
    """Forecast of promoted SKUs between the first and the last promoted day of all."""
    active = daily.filter(F.col("promo_flag") == 1)
    first = active.agg(F.min("ds")).scalar()
    last = active.agg(F.max("ds")).scalar()
    return _promoted_rows(forecast, daily).filter(F.col("ds").between(first, last))


def promo_summary(flagged: DataFrame, daily: DataFrame) -> DataFrame:
    """Mean, median and number of forecast days per promoted SKU, on and off promotion."""
    is_promo = (F.coalesce("promo_flag", F.lit(0)) == 1).alias("is_promo")
    keys = [k for k in PAIR if k in flagged.columns]
    return (
        _promoted_rows(flagged, daily)
        .groupBy(*keys, "Shop_SKU", is_promo)
        .agg(
            F.avg("yhat").alias("avg_yhat"),
            F.median("yhat").alias("median_yhat"),
            F.count("yhat").alias("n_days"),
        )
    )
