"""Job: raw shipment and order logs to gap-free daily demand."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockcast.operators.clean import adapt, clean, eligible_rows, rename_skus, union_sources
from stockcast.operators.demand import daily_demand, dense_demand
from stockcast.session import materialize
from stockcast.settings import SPECIAL_CUSTOMER, SPECIAL_CUTOFF, SPINE_START
from stockcast.sources.tables import scan_orders, scan_shipments


def clean_sources(
    shipments: DataFrame,
    orders: DataFrame,
    renames: DataFrame,
    *,
    as_of: str,
    special_customer: str = SPECIAL_CUSTOMER,
    cutoff: str = SPECIAL_CUTOFF,
) -> DataFrame:
    """Shipments of all customers but one, orders of that one, cleaned and in one table."""
    parts = [
        clean(adapt(scan_shipments(shipments, special_customer), "gi"), as_of),
        clean(adapt(scan_orders(orders, special_customer), "oms_order"), as_of),
    ]
    kept = [eligible_rows(rename_skus(part, renames), special_customer, cutoff) for part in parts]
    return union_sources(*kept)


def prepare_sales(shipments: DataFrame, orders: DataFrame, renames: DataFrame, **options) -> DataFrame:
    """Sums of the days with sales of every series, written down: the raw logs are to be read just once."""
    return materialize(daily_demand(clean_sources(shipments, orders, renames, **options)))


def prepare_demand(
    shipments: DataFrame, orders: DataFrame, renames: DataFrame, *, start: str = SPINE_START, **options
) -> DataFrame:
    """Daily demand of every series from `start` to the last day with data, gaps filled with 0.

    The sparse daily sums are written down in between, as filling needs the last day of the whole table first.
    """
    return dense_demand(prepare_sales(shipments, orders, renames, **options), start)
