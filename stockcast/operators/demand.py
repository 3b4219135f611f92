"""Gap-free daily demand per series, and the cuts the jobs take from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockcast import PAIR, SERIES


def daily_demand(rows: DataFrame) -> DataFrame:
    """One row per series and day. Partial sums run before the shuffle, so hot keys stay small."""
    return rows.groupBy("ds", *SERIES).agg(F.sum("y").alias("y"))


def series_keys(rows: DataFrame) -> DataFrame:
    return rows.select(*SERIES).distinct()


def date_spine(rows: DataFrame, start: str) -> DataFrame:
    """Every day from `start` to the last day seen for any series."""
    last = rows.agg(F.max("ds").alias("last"))
    first = F.lit(start).cast("date")
    return last.filter(F.col("last") >= first).select(F.explode(F.sequence(first, F.col("last"))).alias("ds"))


def dense_demand(daily: DataFrame, start: str) -> DataFrame:
    """Fill each series with zeros from `start` to the last day of the whole table.

    Instead of joining a series-by-day grid, each sale carries the zero days up to the series' next
    sale. Only the sparse sales are shuffled, by series; the filled rows are made where they land.
    A series has at most one row per day, so no window outgrows the calendar.
    """
    first = F.lit(start).cast("date")
    in_order = Window.partitionBy(*SERIES).orderBy("ds")
    last = daily.agg(F.max("ds")).scalar()
    gaps = daily.withColumns(
        {
            "_from": F.when(F.lag("ds").over(in_order).isNull(), first).otherwise(
                F.greatest(F.col("ds"), first)
            ),
            "_to": F.coalesce(F.date_sub(F.lead("ds").over(in_order), 1), last),
        }
    ).filter(F.col("_from") <= F.col("_to"))
    days = gaps.select("*", F.explode(F.sequence("_from", "_to")).alias("_day"))
    sold = F.when(F.col("_day") == F.col("ds"), F.coalesce(F.col("y"), F.lit(0.0)))
    return days.select(F.col("_day").alias("ds"), *SERIES, F.coalesce(sold, F.lit(0.0)).alias("y"))


def filter_scope(demand: DataFrame, pairs: DataFrame) -> DataFrame:
    """Demand of the wanted pairs only; a pair without demand yields nothing."""
    return demand.join(pairs.select(*PAIR).distinct(), PAIR, "left_semi")


def filter_customer(demand: DataFrame, customer_code: str, warehousecode: str | None = None) -> DataFrame:
    """One customer's demand. An unknown customer is an error, an unknown warehouse is empty."""
    found = demand.filter(F.col("customer_code") == customer_code)
    if found.isEmpty():
        raise ValueError(f"No data found for customer_code={customer_code}")
    if warehousecode is None or "warehousecode" not in demand.columns:
        return found
    return found.filter(F.col("warehousecode") == warehousecode)


def collapse_warehouses(demand: DataFrame, name: str | None = None) -> DataFrame:
    """Customer-level demand: one row per SKU and day over all warehouses."""
    summed = demand.groupBy("ds", "customer_code", "Shop_SKU").agg(F.sum("y").alias("y"))
    return summed.withColumn("warehousecode", F.lit(name).cast("string")).select("ds", *SERIES, "y")


def series_latest(stats: DataFrame) -> DataFrame:
    """Each series with its pair's last day.

    Pair values reach the demand through its series, never by a join on the pair: rows shuffled by
    pair would put a hot pair, and every window after it, in one task.
    """
    return stats.join(pair_latest(stats), PAIR).select(*SERIES, "latest_date")


def _against_latest(demand: DataFrame, latest: DataFrame | None, keep) -> DataFrame:
    if latest is None:
        latest = series_latest(demand.groupBy(*SERIES).agg(F.max("ds").alias("last_ds")))
    dated = demand.join(latest.select(*SERIES, "latest_date"), SERIES)
    return dated.filter(keep(F.col("ds"), F.col("latest_date"))).select(*demand.columns)


def train_split(demand: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    return _against_latest(demand, latest, lambda ds, last: ds <= F.date_sub(last, 1))


def test_split(demand: DataFrame, test_days: int, latest: DataFrame | None = None) -> DataFrame:
    return _against_latest(demand, latest, lambda ds, last: ds > F.date_sub(last, test_days))


def missing_days(demand: DataFrame, as_of: str, by: list[str] = PAIR) -> DataFrame:
    """Days the feed is behind: from the last day with data to the day before `as_of`."""
    expected = F.date_sub(F.lit(as_of).cast("date"), 1)
    late = F.greatest(F.lit(0), F.datediff(expected, F.col("last_ds")))
    return (
        demand.groupBy(*by)
        .agg(F.max("ds").alias("last_ds"))
        .select(
            *by,
            F.coalesce(late, F.lit(0)).cast("int").alias("dif_days"),
            "last_ds",
            expected.alias("expected_last"),
        )
    )


def series_stats(demand: DataFrame) -> DataFrame:
    """What the jobs need to know of each series, from one pass over the demand.

    A series has one row per day, so `last_y` is the demand of its last day.
    """
    dated = F.when(F.col("ds").isNotNull(), F.col("y"))
    mean = F.avg("y")
    return demand.groupBy(*SERIES).agg(
        F.when(mean > 0, mean).otherwise(0.0).alias("rate"),
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count("ds").alias("n_dated"),
        F.sum(dated).alias("sum_y"),
        F.max_by("y", "ds").alias("last_y"),
    )


def pair_latest(stats: DataFrame) -> DataFrame:
    return stats.groupBy(*PAIR).agg(F.max("last_ds").alias("latest_date"))


def series_volume(train: DataFrame) -> DataFrame:
    return train.groupBy(*SERIES).agg(F.sum("y").alias("volume"))


def train_volume(series: DataFrame) -> DataFrame:
    """Add the volume up to the day before the pair's last day, without reading the demand again.

    Rows are series statistics with the pair's latest_date.
    """
    cut = F.when(F.col("last_ds") == F.col("latest_date"), F.coalesce("last_y", F.lit(0.0))).otherwise(0.0)
    return series.withColumn("volume", F.coalesce("sum_y", F.lit(0.0)) - cut)


def coefficient_of_variation(y: Column) -> Column:
    return F.try_divide(F.stddev_samp(y), F.avg(y))


def series_profile(train: DataFrame) -> DataFrame:
    """Volume and coefficient of variation of each series, from one aggregation."""
    return train.groupBy(*SERIES).agg(
        F.sum("y").alias("volume"), coefficient_of_variation(F.col("y")).alias("cv")
    )


def validate_inputs(stats: DataFrame, holidays: DataFrame | None) -> DataFrame:
    """One row per pair, from its series' statistics, with the reason it cannot be trained, or null."""
    if holidays is None:
        raise ValueError("holidays are required")
    by_end = stats.groupBy(*PAIR, "last_ds").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_dated").alias("n_dated"),
        F.sum("sum_y").alias("sum_y"),
        F.count("last_ds").alias("n_last"),
        F.sum("last_y").alias("y_last"),
    )
    last_day = F.max_by(F.struct("n_last", "y_last"), F.col("last_ds")).alias("_last")
    totals = by_end.groupBy(*PAIR).agg(
        F.max("last_ds").alias("latest"),
        *[F.sum(c).alias(c) for c in ("n_rows", "n_dated", "sum_y")],
        last_day,
    )
    zero = F.lit(0.0)
    checked = totals.select(
        *PAIR,
        "n_rows",
        (F.col("n_dated") - F.coalesce("_last.n_last", F.lit(0))).alias("train_rows"),
        (F.coalesce("sum_y", zero) - F.coalesce("_last.y_last", zero)).alias("train_volume"),
        "latest",
    )
    reason = (
        F.when(F.col("latest").isNull(), "no valid ds")
        .when(F.col("train_rows") <= 0, "train is empty")
        .when(F.col("train_volume") <= 0, "total volume is 0")
    )
    return checked.withColumn("reason", reason).drop("latest")
