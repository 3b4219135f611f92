"""Scans. Filters and column lists stay declarative, so they reach the Parquet or JDBC reader."""

from __future__ import annotations

import logging
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stockcast import schemas
from stockcast.session import materialize
from stockcast.settings import SKU_RENAMES

log = logging.getLogger(__name__)
RENAMES = "customer_code string, old_sku string, new_sku string"


def read_table(
    spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def jdbc_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    num_partitions: int = 64,
    fetchsize: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options for a chunked database scan: many range queries, each fetched in batches."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetchsize), **extra}
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(num_partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def read_optional(spark: SparkSession, read: Callable[[], DataFrame], schema: str) -> DataFrame:
    """A source that may be unavailable: then a warning and an empty table with the schema.

    The rows are written down at once, so a source that fails while it is read counts as unavailable too, and later steps
    do not depend on it. Let `read` cut the rows and columns to those needed.
    """
    try:
        return materialize(read())
    except Exception as problem:  # whatever keeps this source away must not stop the others
        log.warning("source unavailable, going on without it: %s", problem)
        return small_table(spark, [], schema)


def scan_shipments(shipments: DataFrame, special_customer: str) -> DataFrame:
    """Every customer but the special one; rows without a customer drop out too."""
    return shipments.filter(F.col("customercode").cast("string") != special_customer)


def scan_orders(orders: DataFrame, special_customer: str) -> DataFrame:
    return orders.filter(F.col("sendercode").cast("string") == special_customer)


def active_config(config: DataFrame) -> DataFrame:
    return config.filter(F.col("is_active"))


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of a request as a local table, whose known size lets Spark choose the join."""
    kind = T.StructType.fromDDL(schema)
    columns = [list(c) for c in zip(*rows)] or [[] for _ in kind]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, to_arrow_schema(kind))]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=kind.names), kind)


def sku_renames(spark: SparkSession, renames: dict[str, dict[str, str]] = SKU_RENAMES) -> DataFrame:
    rows = [(customer, old, new) for customer, pairs in renames.items() for old, new in pairs.items()]
    return small_table(spark, rows, RENAMES)


def promotions_from_json(documents: DataFrame, column: str = "promotions") -> DataFrame:
    """Promotion documents (each a JSON array) to one row per promotion."""
    parsed = F.from_json(F.col(column), f"array<struct<{schemas.PROMOTION}>>")
    return documents.select(F.inline(parsed))
