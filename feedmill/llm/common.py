"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.session import scratch_dir

#: What Arrow carries to a Python worker at once, at most: so many rows, and so many bytes but for a single longer row.
BATCH_ROWS = 500
BATCH_BYTES = 8 * 1024 * 1024
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """From now on whole texts go to the session's Python workers in small batches.

    Executor and worker each hold a batch of every task; with Spark's 10,000 rows
    that is a task's whole input. No result depends on where batches end. Frames
    are worked out after they are returned, so the setting stays.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def land(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared scratch folder, and read back.

    Cuts the lineage: a lost executor costs a re-read, not a re-run.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark, label)
    df.write.parquet(folder)
    landed = spark.read.schema(df.schema).parquet(folder)
    landed.landed_at = folder
    return landed


def discard(*landed: DataFrame) -> None:
    """Delete landed tables that nothing lazy reads any more."""
    for df in landed:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.landed_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())
