"""Holiday tables: base holidays, impact dates, promotions, and their daily features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast import PAIR
from stockcast.functions.columns import day
from stockcast.settings import DEFAULT_SETTINGS, HOLIDAY_TOGGLES

HOLIDAY_COLUMNS = ["holiday", "ds", "lower_window", "upper_window"]
_ENTRIES = "array<struct<holiday:string,ds:date,lower_window:int,upper_window:int>>"


def base_holidays(source: DataFrame) -> DataFrame:
    """Parsed, complete and distinct holidays; a source without window columns gets windows of 0."""

    def window(name):
        return F.col(name).cast("int") if name in source.columns else F.lit(0)

    named = source.withColumnRenamed("holiday_code", "holiday")
    return (
        named.select(
            "holiday",
            day(F.col("ds")).alias("ds"),
            window("lower_window").alias("lower_window"),
            window("upper_window").alias("upper_window"),
        )
        .dropna(subset=["holiday", "ds"])
        .dropDuplicates(HOLIDAY_COLUMNS)
    )


def toggle_holidays(holidays: DataFrame, settings: DataFrame | None = None, **flags: bool) -> DataFrame:
    """Keep the holiday codes that are switched on; codes without a switch drop out.

    With `settings`, one row per pair, the result holds the enabled holidays of each pair.
    """
    if settings is None:
        enabled = [code for code, flag in HOLIDAY_TOGGLES.items() if flags.get(flag, True)]
        return holidays.filter(F.col("holiday").isin(enabled))
    codes = [
        F.when(F.coalesce(flag, F.lit(DEFAULT_SETTINGS[flag])), F.lit(code))
        for code, flag in HOLIDAY_TOGGLES.items()
    ]
    # the days of the four known codes as one array, which the calendar bounds: no join on so few keys
    entry = F.struct(*HOLIDAY_COLUMNS)
    known = holidays.filter(F.col("holiday").isin(list(HOLIDAY_TOGGLES))).agg(F.collect_list(entry)).scalar()
    enabled = F.array_compact(F.array(*codes))
    own = settings.withColumns({"_known": F.coalesce(known, F.array().cast(_ENTRIES)), "_on": enabled}).select(
        *PAIR, F.filter("_known", lambda h: F.array_contains("_on", h["holiday"])).alias("_days")
    )
    return own.select(*PAIR, F.inline("_days"))


def impact_holidays(dates: DataFrame, lower: int | None = None, upper: int | None = None) -> DataFrame:
    """Impact dates as holidays. Window columns on the rows win over the parameters."""

    def window(name, value, default):
        own = name in dates.columns
        return (F.col(name) if own else F.lit(default if value is None else value)).cast("int")

    return dates.select(
        *[k for k in PAIR if k in dates.columns],
        F.lit("impact_dates").alias("holiday"),
        "ds",
        window("impact_lower_window", lower, DEFAULT_SETTINGS["impact_lower_window"]).alias("lower_window"),
        window("impact_upper_window", upper, DEFAULT_SETTINGS["impact_upper_window"]).alias("upper_window"),
    )


def promo_holidays(promo_daily: DataFrame, windows: dict | None) -> DataFrame:
    """Promotion days as holidays of their SKU."""
    if windows is None:
        raise ValueError("promotion windows are required")
    return promo_daily.select(
        F.lit("promotion").alias("holiday"),
        "ds",
        F.lit(int(windows.get("lower_window", 0))).alias("lower_window"),
        F.lit(int(windows.get("upper_window", 0))).alias("upper_window"),
        *[k for k in ("customer_code", "Shop_SKU") if k in promo_daily.columns],
    )


def with_impact(holidays: DataFrame, impact: DataFrame) -> DataFrame:
    """Base and impact holidays, each row once. Both or neither carry the pair's key."""
    return holidays.unionByName(impact).distinct()


def series_holidays(keys: DataFrame, pair_holidays: DataFrame, promo: DataFrame) -> DataFrame:
    """All holidays of each series: those of its pair and the promotions of its SKU."""
    wanted = [*keys.columns, *HOLIDAY_COLUMNS]

    def laid_out(holidays: DataFrame, on: list[str]) -> DataFrame:
        """The calendar of a key is one row; it is laid out per series after the join."""
        days = holidays.groupBy(*on).agg(F.collect_list(F.struct(*HOLIDAY_COLUMNS)).alias("_days"))
        return keys.join(days, on).select(*keys.columns, F.inline("_days")).select(*wanted)

    return laid_out(pair_holidays, [k for k in PAIR if k in pair_holidays.columns]).unionByName(
        laid_out(promo, [k for k in ("customer_code", "Shop_SKU") if k in promo.columns])
    )


def holiday_features(holidays: DataFrame) -> DataFrame:
    """One feature per holiday and offset within its window, on the day it is active."""
    others = [c for c in holidays.columns if c not in HOLIDAY_COLUMNS]
    lower = F.least(F.coalesce("lower_window", F.lit(0)), F.coalesce("upper_window", F.lit(0)))
    offsets = F.explode(F.sequence(lower, F.coalesce("upper_window", F.lit(0)))).alias("k")
    spread = holidays.select(*others, "holiday", "ds", offsets)
    name = F.concat("holiday", F.when(F.col("k") < 0, "_minus_").otherwise("_plus_"), F.abs("k").cast("string"))
    return spread.select(*others, name.alias("feature"), F.date_add("ds", F.col("k")).alias("ds")).distinct()
