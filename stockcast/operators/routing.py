"""Which series get the structural model and which the Poisson draw."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast import PAIR, SERIES
from stockcast.operators.ranking import running_total, top_n
from stockcast.settings import VOLUME_SHARE


def pareto_series(volumes: DataFrame, share: float = VOLUME_SHARE) -> DataFrame:
    """The largest series of each pair that together stay within `share` of its volume.

    Where already the largest exceeds the share, it alone is taken. Equal volumes go by SKU. The
    volumes are read four times, so pass a stored table.
    """
    order = [F.desc("volume"), F.asc("Shop_SKU")]
    totals = volumes.groupBy(*PAIR).agg(F.sum("volume").alias("total"))
    running = running_total(volumes, PAIR, order, "volume", "running")
    ranked = running.join(totals, PAIR).withColumn("share", F.try_divide("running", "total"))
    within = ranked.filter(F.col("share") <= share).select(*SERIES, "volume")
    lone = top_n(volumes, PAIR, order, 1).join(within.select(*PAIR).distinct(), PAIR, "left_anti")
    return within.unionByName(lone.select(*SERIES, "volume"))


def model_series(pareto: DataFrame, demand_keys: DataFrame, promo_daily: DataFrame | None) -> DataFrame:
    """Series for the structural model: the large ones and every promoted one that has demand."""
    chosen = pareto.select(*SERIES)
    if promo_daily is not None:
        keys = [k for k in ("customer_code", "Shop_SKU") if k in promo_daily.columns]
        promoted = promo_daily.select(*keys).distinct()
        chosen = chosen.unionByName(demand_keys.select(*SERIES).join(promoted, keys, "left_semi").select(*SERIES))
    return chosen.distinct()


def route(demand_keys: DataFrame, models: DataFrame) -> DataFrame:
    """Each series of the demand with its method; a chosen series without demand yields nothing."""
    marked = models.select(*SERIES, F.lit(True).alias("_model"))
    method = F.when(F.col("_model"), "structural").otherwise("poisson")
    return demand_keys.join(marked, SERIES, "left").select(*demand_keys.columns, method.alias("method"))


def override_series(rows: DataFrame, skus: DataFrame) -> DataFrame:
    """Keep only the rows of the listed SKUs."""
    return rows.join(skus.select("Shop_SKU").distinct(), "Shop_SKU", "left_semi").select(*rows.columns)
