"""Raw shipment and order rows to cleaned rows in canonical columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast import PAIR
from stockcast.functions.columns import day, key_text, number, strip
from stockcast.settings import COLUMN_MAPS, WAREHOUSE_CANDIDATES

CANONICAL = ["ds", *PAIR, "Shop_SKU", "y"]


def adapt(raw: DataFrame, table_type: str, column_maps: dict = COLUMN_MAPS) -> DataFrame:
    """Rename raw columns to canonical ones; of several columns with one name the first stays."""
    mapping = column_maps[table_type]
    names = [mapping.get(name, name) for name in raw.columns]
    first = [names.index(name) == at for at, name in enumerate(names)]
    unique = raw.toDF(*[n if keep else f"_repeat_{at}" for at, (n, keep) in enumerate(zip(names, first))])
    warehouse = next((c for c in WAREHOUSE_CANDIDATES if c in unique.columns), None)
    missing = F.lit(None).cast("string")
    wanted = {
        "ds": F.col("ds"),
        "customer_code": F.col("customer_code"),
        "warehousecode": F.col(warehouse) if warehouse else missing,
        "Shop_SKU": F.col("Shop_SKU"),
        "y": F.col("y"),
        "paymentdate": F.col("paymentdate") if "paymentdate" in unique.columns else missing,
    }
    return unique.select(*[c.alias(name) for name, c in wanted.items()])


def clean(adapted: DataFrame, as_of: str) -> DataFrame:
    """Typed rows up to the day before `as_of`; rows without SKU or date drop out."""
    typed = adapted.filter(F.col("Shop_SKU").isNotNull()).select(
        day(F.col("ds")).alias("ds"),
        *[key_text(F.col(k)).alias(k) for k in PAIR],
        strip(F.col("Shop_SKU")).alias("Shop_SKU"),
        number(F.col("y")).alias("y"),
        day(F.col("paymentdate")).alias("paymentdate"),
    )
    return typed.filter(F.col("ds") <= F.date_sub(F.lit(as_of).cast("date"), 1))


def rename_skus(rows: DataFrame, renames: DataFrame) -> DataFrame:
    """Replace a customer's old SKU code by its new one, one step only.

    No broadcast hint: Spark broadcasts the map while its measured size allows it and otherwise
    shuffles, splitting a hot key at run time.
    """
    lookup = renames.select(
        "customer_code", F.col("old_sku").alias("Shop_SKU"), F.col("new_sku").alias("_new")
    ).dropDuplicates(["customer_code", "Shop_SKU"])
    joined = rows.join(lookup, ["customer_code", "Shop_SKU"], "left")
    return joined.withColumn("Shop_SKU", F.coalesce("_new", "Shop_SKU")).select(*rows.columns)


def eligible_rows(rows: DataFrame, special_customer: str, cutoff: str) -> DataFrame:
    """The special customer counts only from the cutoff on and once paid; the others pass."""
    paid = (F.col("ds") >= F.lit(cutoff).cast("date")) & F.col("paymentdate").isNotNull()
    return rows.filter((F.col("customer_code") != special_customer) | paid)


def union_sources(*sources: DataFrame) -> DataFrame:
    """All cleaned rows in canonical columns; an empty source adds nothing."""
    return reduce(DataFrame.unionByName, [s.select(*CANONICAL) for s in sources])


def demand_profile(rows: DataFrame) -> DataFrame:
    y = number(F.col("y"))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(y), F.lit(0.0)).alias("sum_y"),
        F.count_if(y > 0).alias("nonzero_rows"),
        F.countDistinct("Shop_SKU").alias("n_skus"),
    )


def top_pairs(rows: DataFrame, n: int = 5) -> DataFrame:
    """The `n` customer/warehouse pairs that sold most; null keys count as a pair."""
    totals = rows.groupBy(*PAIR).agg(F.sum(number(F.col("y"))).alias("sum_y"))
    return totals.orderBy(F.desc("sum_y"), *PAIR).limit(n)
