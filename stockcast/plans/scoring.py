"""Job: score promoted SKUs from stored models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast import SERIES
from stockcast.operators import post, promo
from stockcast.operators.structural import parse_models, predict
from stockcast.settings import PERIODS
from stockcast.sources.stores import split_models


def score_models(
    models: DataFrame,
    promo_daily: DataFrame | None,
    periods: int = PERIODS,
    lag_fill: str = "zero",
    clip: bool = True,
) -> DataFrame:
    """The days after each model's training data, with the promotion calendar of the request."""
    scored = predict(parse_models(models), periods, promo_daily, include_history=False, lag_fill=lag_fill)
    return post.int_cleanup(scored) if clip else scored


def score_promotions(
    models: DataFrame,
    promotions: DataFrame,
    *,
    customer_code: str | None = None,
    warehousecode: str | None = None,
    all_skus: DataFrame | None = None,
    periods: int = PERIODS,
    lag_fill: str = "zero",
    by_customer: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Forecast of every promoted SKU that has a usable model, and one status row per candidate series.

    A candidate is a stored series of a listed SKU. Its status is 'ok' or why its document was rejected; a listed SKU
    without any stored series has a row of its own, without customer and warehouse. So forecast series and rejects are
    all candidates. A request that lists no SKU is an error.

    By default SKU codes are shared: a promotion counts for the SKU of every customer, and every customer's stored series of it is a
    candidate. With `by_customer` each customer is scored with the list of their own promotions: only their listed SKUs are
    candidates, only their promotions raise a flag, and a listed SKU without a stored series has a row under that customer.
    """
    key = ["customer_code", "Shop_SKU"] if by_customer else ["Shop_SKU"]
    skus = promo.promo_skus(promotions, by_customer)
    if skus.isEmpty():
        raise ValueError("No SKU found in the promotions' include_sku")
    if customer_code is not None:
        models = models.filter(F.col("customer_code") == customer_code)
        if by_customer:
            skus = skus.filter(F.col("customer_code") == customer_code)
    if warehousecode is not None:
        models = models.filter(F.col("warehousecode") == warehousecode)
    daily = promo.promo_daily(promo.promo_master_valid(promo.promo_master(promotions)), all_skus, by_customer)
    own, rejects = split_models(models.join(skus, key, "left_semi").select(*models.columns))
    seen = own.select(*SERIES, F.lit("ok").alias("_state")).unionByName(rejects.select(*SERIES, F.col("reason").alias("_state")))
    status = skus.join(seen, key, "left").select(*SERIES, F.coalesce("_state", F.lit("missing model")).alias("status"))
    forecast = score_models(own, daily, periods, lag_fill)
    return forecast.select("ds", *SERIES, *post.VALUES, "promo_flag"), status
