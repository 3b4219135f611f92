"""Rankings inside groups, of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockcast.session import materialize


def top_n(rows: DataFrame, group: list[str], order: list[Column], n: int | Column, salts: int = 32) -> DataFrame:
    """The first `n` rows of each group. Exact, in two steps.

    Each group is first cut to `n` rows within each of `salts` hash slices, so the second ranking
    sees at most `salts * n` rows of a group, however large the group is.
    """
    limit = n if isinstance(n, Column) else F.lit(n)
    others = [c for c in rows.columns if c not in group]
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(*others), F.lit(salts)))
    within = Window.partitionBy(*group, "_slice").orderBy(*order)
    overall = Window.partitionBy(*group).orderBy(*order)
    short = sliced.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= limit)
    return short.withColumn("rank", F.row_number().over(overall)).filter(F.col("rank") <= limit).drop("_slice")


def running_total(rows: DataFrame, group: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """Running sum of `value` within each group, with no group gathered in one task.

    The rows are range-partitioned in (group, order), summed within each range, and each range gets
    the total of the ranges before it. Ranges come from sampling, so they are written down once:
    both uses below must see the same ones, also after an executor is lost.
    """
    ranged = materialize(
        rows.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id())
    )
    inside = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per group and range: this window is as long as the number of partitions
    carried = (
        ranged.groupBy(*group, "_range")
        .agg(F.sum(value).alias("_sum"))
        .select(*group, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0)).alias("_carried"))
    )
    summed = ranged.withColumn("_inside", F.sum(value).over(inside)).join(carried, [*group, "_range"])
    return summed.withColumn(name, F.col("_carried") + F.col("_inside")).select(*rows.columns, name)
