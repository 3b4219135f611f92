"""Session settings the jobs rely on, and the one place that writes intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows shuffled by pair do not serve a grouping by series, so a hot pair can still be split
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # the windows and fits do much work per byte: merge small partitions, but not down to one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # codes such as 0000000811 keep their leading zeros when read back from partition folders
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # one row of the fitting stage holds a whole series, so batches stay short
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(app: str = "stockcast", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: folders of local sessions that name none, by application; removed when Python ends
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local session without one gets a temporary one.

    The setting belongs to the cluster and cannot be changed in a running session, so the temporary folder is
    only remembered here.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="stockcast-")
        atexit.register(shutil.rmtree, _LOCAL[application], ignore_errors=True)
    return _LOCAL[application]


def run_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_folder(spark)}/stockcast/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and go on from the written table.

    A lost executor then does not redo the work before it, several readers do not repeat it, and
    the planner knows the table's size.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_tables(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, in whatever store the folder is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def run(spark: SparkSession) -> Iterator[None]:
    """A whole run: intermediate tables are removed at its end, also after an error.

    Results are lazy, so write or collect them inside.
    """
    try:
        yield
    finally:
        remove_tables(spark)
