"""Poisson forecast for the many small series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast import SERIES
from stockcast.functions.columns import uniform
from stockcast.functions.poisson import poisson_bounds, poisson_draw
from stockcast.operators.promo import with_promo_days
from stockcast.settings import SEED

#: draws are counts in 64 bits
LARGEST_RATE = 1e15


def bad_rates(spans: DataFrame) -> DataFrame:
    """Series that cannot be drawn, with the reason. They take no part in the forecast, so that they stop no other."""
    reason = F.when(F.isnan("rate") | (F.abs("rate") == float("inf")), "the rate is not a finite number").when(
        F.col("rate") > LARGEST_RATE, "the rate is beyond the counts"
    )
    return spans.select(*SERIES, reason.alias("error")).filter(F.col("error").isNotNull())


def poisson_forecast(
    spans: DataFrame,
    periods: int,
    seed: int = SEED,
    keep: tuple[str, ...] = (),
    promo_daily: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """A repeatable draw for every day of the history and `periods` days more, of every series with a usable rate.

    The days come from each series' span (its demand has no gaps), so the demand is not read again.
    Each row grows to hundreds, so the few spans are first spread over `parts` tasks. An own `periods` column of the
    spans wins over the parameter; columns in `keep` are carried on. With `promo_daily` each row has its promotion
    flag, from one array of days per span.
    """
    ahead = F.col("periods") if "periods" in spans.columns else F.lit(periods)
    end = F.date_add(F.col("last_ds"), ahead.cast("int"))
    parts = parts or int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    usable = spans.filter(~F.isnan("rate") & (F.abs("rate") <= LARGEST_RATE) | F.col("rate").isNull())
    flag = []
    if promo_daily is not None:
        usable = with_promo_days(usable, promo_daily)
        flag = [F.coalesce(F.array_contains("_promo", F.unix_date("ds")), F.lit(False)).cast("int").alias("promo_flag")]
    spread = usable.repartition(parts, *SERIES)
    carried = [*keep, *(["_promo"] if flag else [])]
    days = spread.select(*SERIES, "rate", *carried, F.explode(F.sequence("first_ds", end)).alias("ds"))
    drawn = days.withColumn("_draw", poisson_draw("rate", uniform(seed, *map(F.col, [*SERIES, "ds"]))))
    return drawn.select("ds", *SERIES, "_draw.yhat", "_draw.yhat_lower", "_draw.yhat_upper", *flag, *keep)


def poisson_quantiles(means: DataFrame) -> DataFrame:
    """95 % interval for each distinct mean."""
    distinct = means.select("mean").distinct()
    return distinct.withColumn("_b", poisson_bounds("mean")).select("mean", "_b.yhat_lower", "_b.yhat_upper")
