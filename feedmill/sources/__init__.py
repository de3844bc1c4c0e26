"""Readers. Line sources give a ``value`` column of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.schemas import QUAKE_COLUMNS
from feedmill.sources import quoted_csv

# The class behind format("avro"). Naming it works with and without the
# separately shipped module that registers the short name.
AVRO_FORMAT = "org.apache.spark.sql.avro.AvroFileFormat"


# A carriage return is white space inside a document, not the end of a line.
LINE_END = "\n"


def read_lines(spark: SparkSession, paths: str | list[str], with_source: bool = False) -> DataFrame:
    """Text lines of every file the paths or globs name."""
    lines = spark.read.option("lineSep", LINE_END).text(paths)
    if with_source:
        return lines.select("value", F.col("_metadata.file_path").alias("source_file"))
    return lines


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None, with_source: bool = False) -> DataFrame:
    """Text lines of files as they arrive in a folder."""
    reader = spark.readStream.option("lineSep", LINE_END)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path)
    if with_source:
        return lines.select("value", F.col("_metadata.file_path").alias("source_file"))
    return lines


def utf8_text(payload: Column) -> Column:
    """Message bytes as text; NULL (a malformed line) when they are not UTF-8."""
    as_text = payload.cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text)


def stream_kafka_lines(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Messages of one topic as text lines. Needs Spark's Kafka module."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )
    return messages.select(utf8_text(F.col("value")).alias("value"))


def read_quake_csv(
    spark: SparkSession, paths: str | list[str], multi_line: bool = True, split: bool = False
) -> DataFrame:
    """Earthquake CSV as text columns, picked by header name.

    Quoted fields may hold line breaks, which makes each file one task. With
    ``split`` many tasks read a file all the same (``quoted_csv``), in two scans;
    for files without such fields ``multi_line=False`` lets Spark split them in one.
    Files read together must share one header (the job stops if one differs);
    other columns are ignored.
    """
    if split:
        return quoted_csv.read_quoted_csv(spark, paths).select(*QUAKE_COLUMNS)
    rows = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .csv(paths)
    )
    return rows.select(*QUAKE_COLUMNS)


def read_parquet(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format(AVRO_FORMAT).load(path)
