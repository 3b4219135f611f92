"""Time the headline queries and print one JSON line. BENCH_SF_DIR and BENCH_CPUS set the scale."""

from __future__ import annotations

import json
import os
import sys
import time

from catalog import fixtures as fx
from catalog.queries import REGISTRY
from stockcast import SERIES
from stockcast.operators import calendar, config, demand, impact, poisson, routing, structural
from stockcast.session import build_session, materialize, run as run_and_remove

HEADLINE = [
    "prep_demand",
    "zscore_detail",
    "impact_dates",
    "pareto_skus",
    "lag_features",
    "promo_daily",
    "config_effective",
    "poisson_quantiles",
    "poisson_forecast",
    "structural_fit",
    "structural_forecast",
    "score_promos",
    "scoped_replace",
    "train_forecast",
]


def grown_impact(spark, rows, series):
    """Impact dates of the top series, one pair holding a third of the sales."""
    top = materialize(impact.top_series(series, 30))
    return impact.impact_dates(impact.top_demand(rows, top), top)


def grown_pareto(spark, rows, series):
    return routing.pareto_series(series.select(*SERIES, "volume"))


def grown_draws(spark, rows, series):
    return poisson.poisson_forecast(series, 14)


def grown_fit(spark, rows, series):
    """Fits of all series of the rankings."""
    chosen = config.with_defaults(routing.pareto_series(series.select(*SERIES, "volume")).select(*SERIES))
    base = calendar.base_holidays(spark.createDataFrame([], "holiday string, ds date, lower_window int, upper_window int"))
    return structural.fit_models(structural.fit_inputs(rows, chosen, base))


#: over stored demand whose series grow with the scale factor
GROWN = {f.__name__: f for f in (grown_impact, grown_pareto, grown_draws, grown_fit)}


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(spark, names: list[str], sf_dir: str) -> dict[str, float]:
    times = {}
    for name in (n for n in names if n in REGISTRY):
        begin = time.time()
        noop(REGISTRY[name](spark, sf_dir))
        times[name] = round(time.time() - begin, 3)
    if grown := [n for n in names if n in GROWN]:
        begin = time.time()
        rows = materialize(fx.growing_demand(spark, sf_dir))
        times["grown_prep"] = round(time.time() - begin, 3)
        stats = materialize(demand.series_stats(rows))
        series = materialize(demand.train_volume(stats.join(demand.series_latest(stats), SERIES)))
        for name in grown:
            begin = time.time()
            noop(GROWN[name](spark, rows, series))
            times[name] = round(time.time() - begin, 3)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    names = sys.argv[1:] or [*HEADLINE, *GROWN]
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    with run_and_remove(spark):
        timed(spark, names, warm_dir)  # compile the code once on the smallest tables, so that the times are of the work
        times = timed(spark, names, sf_dir)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
