"""Which customer/warehouse pairs a run covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast import PAIR
from stockcast.functions.columns import strip


def scope_pairs(source: DataFrame) -> DataFrame:
    """Distinct pairs with trimmed codes; of several names the alphabetically first."""
    known = source.filter(F.col("customercode").isNotNull() & F.col("warehousecode").isNotNull())
    text = known.select(
        *[strip(F.col(c)).alias(c) for c in ("customercode", "warehousecode")],
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("customername", "warehousename")],
    )
    return (
        text.filter((F.col("customercode") != "") & (F.col("warehousecode") != ""))
        .groupBy("customercode", "warehousecode")
        .agg(F.min("customername").alias("customername"), F.min("warehousename").alias("warehousename"))
    )


def resolve_scope(scope: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Pairs to run. Listed warehouses are taken as they are, an empty list means all of the scope."""
    known = scope.select(F.col("customercode").alias("customer_code"), "warehousecode")
    if requests is None:
        return known.distinct()
    listed = F.coalesce(F.size("warehousecodes"), F.lit(0)) > 0
    named = requests.filter(listed).select("customer_code", F.explode("warehousecodes").alias("warehousecode"))
    open_ended = requests.filter(~listed).select("customer_code").distinct()
    expanded = known.join(open_ended, "customer_code", "left_semi")
    named = named.filter(F.col("warehousecode").isNotNull())
    return named.unionByName(expanded.select(*PAIR)).distinct()
