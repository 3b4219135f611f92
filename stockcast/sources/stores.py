"""Published forecasts and the model store: partitioned Parquet folders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast import SERIES, schemas
from stockcast.functions.columns import safe_key
from stockcast.operators.post import published_rows

_PUBLISHED_KEYS = ["customercode", "warehousecode"]
_MODEL_KEYS = ["customer_code", "warehousecode"]


def replace_published(batch: DataFrame, path: str) -> None:
    """Overwrite just the pairs in the batch, the one without warehouse included.

    Rows are rebalanced by pair, so a pair of any size is written by as many tasks as it needs. An
    empty batch changes nothing.
    """
    (
        published_rows(batch)
        .hint("rebalance", *_PUBLISHED_KEYS)
        .write.partitionBy(*_PUBLISHED_KEYS)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PUBLISHED).parquet(path)


def write_demand(demand: DataFrame, path: str) -> None:
    """Store the demand by customer, so that a run over some customers reads only their folders.

    Files hold whole series in order: they compress well, and a grouping by series gathers most of a
    series before it shuffles.
    """
    placed = demand.hint("rebalance", "customer_code").sortWithinPartitions(*SERIES, "ds")
    placed.write.partitionBy("customer_code").mode("overwrite").parquet(path)


def read_demand(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DEMAND).parquet(path).select("ds", *SERIES, "y")


def object_path(customer: Column, warehouse: Column, sku: Column) -> Column:
    """Where a series' document belongs; without warehouse under the fixed folder 'prophet'."""
    folder = F.when(F.coalesce(warehouse, F.lit("")) != "", safe_key(warehouse)).otherwise("prophet")
    return F.concat(safe_key(customer), F.lit("/"), folder, F.lit("/"), safe_key(sku), F.lit(".json"))


def model_rows(fitted: DataFrame, trained_at: str, run_id: str | None = None) -> DataFrame:
    """Model documents in the shape of the store. `trained_at` is the moment of the run, not just its day: it decides
    which of two documents of a series is the newer one, and `run_id` decides between runs of one moment."""
    last = F.get_json_object("model_json", "$.last_ds").try_cast("date")
    return fitted.filter(F.col("model_json").isNotNull()).select(
        *SERIES,
        object_path(*map(F.col, SERIES)).alias("object_path"),
        "model_json",
        last.alias("last_ds"),
        F.lit(trained_at).cast("timestamp").alias("trained_at"),
        F.lit(run_id).cast("string").alias("run_id"),
    )


def write_models(rows: DataFrame, path: str) -> None:
    """Add documents to the store. Readers take the newest per series, so a rerun does no harm."""
    rows.hint("rebalance", *_MODEL_KEYS).write.partitionBy(*_MODEL_KEYS).mode("append").parquet(path)


def read_models(spark: SparkSession, path: str) -> DataFrame:
    return newest_models(spark.read.schema(schemas.MODEL_STORE).parquet(path))


def newest_models(rows: DataFrame) -> DataFrame:
    """The document of each series' latest run. Sums are taken before the shuffle, so of many versions in one file one moves."""
    others = [c for c in rows.columns if c not in SERIES]
    newest = F.max_by(F.struct(*others), F.struct("trained_at", "run_id")).alias("_m")
    return rows.groupBy(*SERIES).agg(newest).select(*SERIES, "_m.*")


def document_state(document: Column) -> Column:
    """'ok', or why a stored model document cannot be used. What looks like JSON is parsed, and must have what a
    prediction needs."""
    text = F.ltrim(F.regexp_replace(document, r"^\s+", ""))
    model = F.from_json(text, schemas.MODEL_BODY)
    needed = ("mode", "first_ds", "last_ds", "span_days", "y_scale", "slope", "level", "regressors", "sigma")
    complete = reduce(lambda a, b: a & b, [model[n].isNotNull() for n in needed])
    return (
        F.when(document.isNull() | (text == ""), "empty")
        .when(text.startswith("<"), "html")
        .when(~text.startswith("{"), "not json")
        .when(F.try_parse_json(text).isNull(), "broken json")
        .when(~F.coalesce(complete, F.lit(False)), "incomplete")
        .otherwise("ok")
    )


def check_documents(documents: DataFrame, column: str = "model_json") -> DataFrame:
    return documents.withColumn("state", document_state(F.col(column)))


def usable_models(rows: DataFrame) -> DataFrame:
    """Documents that parse; a bad one fails the query. `split_models` keeps the bad ones apart instead."""
    checked = check_documents(rows)
    failure = F.raise_error(F.concat(F.lit("bad model document: "), "state"))
    return checked.withColumn(
        "model_json", F.when(F.col("state") == "ok", F.col("model_json")).otherwise(failure)
    ).drop("state")


def split_models(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable documents, and the rejects with their reason. Together they are all rows."""
    checked = check_documents(rows)
    good = checked.filter(F.col("state") == "ok").drop("state")
    paths = [c for c in ("object_path", "trained_at", "run_id") if c in rows.columns]
    return good, checked.filter(F.col("state") != "ok").select(*SERIES, *paths, F.col("state").alias("reason"))
