"""The jobs: each reads, runs the row functions and writes; all spark-submit-able."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.session import scratch_dir
from feedmill.sinks import write_parquet
from feedmill.sources import read_parquet


def land(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Judged rows written once to the shared scratch folder, and read back.

    Two outputs of one parse would otherwise parse twice. The copy is columnar,
    holds the raw line only where it is needed (on rejects), and outlives a lost
    executor.
    """
    slim = rows.withColumn("line", F.when(F.col("reason").isNotNull(), F.col("line")))
    return read_parquet(spark, write_parquet(slim, scratch_dir(spark, label), "SNAPPY"))
