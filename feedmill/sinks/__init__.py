"""Writers. All of them write from the executors and give back the path."""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.sources import AVRO_FORMAT

# Codec names users pass, and Spark's names for them (fixed values).
PARQUET_CODECS = {"NONE": "none", "SNAPPY": "snappy", "GZIP": "gzip", "LZ4": "lz4_raw"}
AVRO_CODECS = {"null": "uncompressed", "deflate": "deflate", "snappy": "snappy"}


def _sharded(df: DataFrame, shards: int | None) -> DataFrame:
    """Exactly ``shards`` files if asked for, else one per task.

    A round-robin exchange keeps the parsing above it parallel; coalescing to
    one partition would squeeze the whole job into one task.
    """
    return df if shards is None else df.repartition(shards)


def _codec(known: dict[str, str], name: str) -> str:
    for key, spark_name in known.items():
        if name.lower() in (key.lower(), spark_name):
            return spark_name
    raise ValueError(f"unknown codec {name!r}; choose one of {', '.join(known)}")


def write_parquet(
    df: DataFrame, path: str, codec: str = "GZIP", shards: int | None = None, mode: str = "errorifexists"
) -> str:
    writer = _sharded(df, shards).write.mode(mode)
    writer.option("compression", _codec(PARQUET_CODECS, codec)).parquet(path)
    return path


def write_avro(
    df: DataFrame,
    path: str,
    schema: str,
    codec: str = "deflate",
    shards: int | None = None,
    mode: str = "errorifexists",
) -> str:
    """Avro container files with exactly the given record schema."""
    writer = _sharded(df, shards).write.format(AVRO_FORMAT).mode(mode)
    writer.option("avroSchema", schema).option("compression", _codec(AVRO_CODECS, codec)).save(path)
    return path


# Nulls are written out, and clock values keep their microseconds.
_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def json_text(df: DataFrame) -> Column:
    """Each row as one JSON object."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), _JSON_OPTIONS)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """One JSON object per line; an ``s3a://`` path writes to a bucket."""
    df.select(json_text(df).alias("value")).write.mode(mode).text(path)
    return path


def kafka_messages(df: DataFrame) -> DataFrame:
    """Rows as messages: a random UUID key and the row's JSON text."""
    return df.select(F.uuid().alias("key"), json_text(df).alias("value"))


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Send rows to a topic. Needs Spark's Kafka module."""
    (
        kafka_messages(df)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def print_rows(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)


def output_name(input_path: str, folder: str, codec: str, extension: str) -> str:
    """``folder/<input file name>.<codec>.<extension>``."""
    return posixpath.join(folder, f"{posixpath.basename(input_path)}.{codec}.{extension}")


Writer = Callable[[DataFrame, str], str]


def writer(extension: str, codec: str, avro_schema: str | None = None, mode: str = "errorifexists") -> Writer:
    """The write step for a (format, codec) pair."""
    if extension == "parquet":
        return lambda df, path: write_parquet(df, path, codec, mode=mode)
    if extension == "avro":
        if avro_schema is None:
            raise ValueError("an Avro output needs a record schema")
        return lambda df, path: write_avro(df, path, avro_schema, codec, mode=mode)
    raise ValueError(f"unknown output format {extension!r}")
