"""Impact dates: days on which a large series strays far from its recent level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockcast import PAIR, SERIES
from stockcast.operators.demand import train_split
from stockcast.operators.prefilter import keep_wanted
from stockcast.operators.ranking import top_n
from stockcast.settings import DEFAULT_SETTINGS, ZSCORE_RULES


def top_series(series: DataFrame, n: int | None = None) -> DataFrame:
    """The series of each pair that sold most, with their rank; equal volumes go by SKU.

    Without `n` the rows' own impact_top_skus_n says how many.
    """
    limit = F.col("impact_top_skus_n") if n is None else n
    return top_n(series, PAIR, [F.desc("volume"), F.asc("Shop_SKU")], limit)


def top_demand(demand: DataFrame, top: DataFrame) -> DataFrame:
    """Demand of the top series before their pair's last day. `top` (written down, with latest_date) is read twice: its filter cuts
    the demand where it is scanned, so that only the top series' rows are exchanged, however many series that are."""
    return train_split(keep_wanted(demand, top, SERIES), top)


def zscore_detail(
    train: DataFrame, top: DataFrame, rules: list[tuple[int, float]] = ZSCORE_RULES
) -> DataFrame:
    """Rolling z-score of the top series by the rule of their coefficient-of-variation band.

    Only the few top series of each pair reach the windows, which run per series. Band columns of
    the top rows win over the built-in bands.
    """
    rules = sorted(rules, key=lambda rule: rule[0], reverse=True)
    bands = ["impact_cv_band_low", "impact_cv_band_high"]
    low, high = (F.col(b) if b in top.columns else F.lit(DEFAULT_SETTINGS[b]) for b in bands)
    top = top.select(*SERIES, *[b for b in bands if b in top.columns])
    whole = Window.partitionBy(*SERIES)
    cv = F.try_divide(F.stddev_samp("y").over(whole), F.avg("y").over(whole))
    last = len(rules) - 1
    band = (
        F.when(F.col("cv").isNull() | (F.col("cv") < low), 0)
        .when(F.col("cv") < high, min(1, last))
        .otherwise(min(2, last))
    )
    rows = train.join(top, SERIES).withColumn("cv", cv).withColumn("rule", band)

    def by_rule(expression):
        chosen = F.lit(None).cast("double")
        for at, (window, threshold) in enumerate(rules):
            chosen = F.when(F.col("rule") == at, expression(window, threshold)).otherwise(chosen)
        return chosen

    in_order = Window.partitionBy(*SERIES).orderBy("ds")

    def full(window, value):
        return F.when(F.col("_at") >= window, value("y").over(in_order.rowsBetween(-(window - 1), 0)))

    rolled = rows.withColumn("_at", F.row_number().over(in_order)).withColumns(
        {
            "rolling_mean": by_rule(lambda window, _: full(window, F.avg)),
            "rolling_std": by_rule(lambda window, _: F.nullif(full(window, F.stddev_samp), F.lit(0.0))),
            "threshold": by_rule(lambda _, threshold: F.lit(threshold)),
        }
    )
    z = F.try_divide(F.col("y") - F.col("rolling_mean"), "rolling_std")
    return rolled.select("ds", *SERIES, "y", "rule", z.alias("z_score"), "threshold")


def impact_dates(train: DataFrame, top: DataFrame, rules: list[tuple[int, float]] = ZSCORE_RULES) -> DataFrame:
    """Distinct impact days of each pair; one day counts for every SKU of the pair."""
    scored = zscore_detail(train, top, rules)
    return scored.filter(F.abs("z_score") > F.col("threshold")).select(*PAIR, "ds").distinct()
