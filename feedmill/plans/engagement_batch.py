"""Fan engagement job: JSON lines to validated Avro, then a completion message."""

from __future__ import annotations

import argparse

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from feedmill.operators import engagement
from feedmill.operators.quality import Output, manifest
from feedmill.plans import land
from feedmill.schemas import ENGAGEMENT_AVRO
from feedmill.session import prepare, scan_task_size
from feedmill.sinks import write_avro, write_kafka, write_parquet
from feedmill.sources import read_lines


def run(
    spark: SparkSession,
    input_path: str | list[str],
    output_path: str,
    rejects_path: str | None = None,
    zone: str = "UTC",
    on_crash: str = "reject",
    codec: str = "deflate",
    shards: int | None = None,
    mode: str = "errorifexists",
) -> dict[str, int]:
    """Write the valid rows as Avro and, if a folder is given, the rejects as Parquet.

    Gives the lines seen and the rows per outcome; every line is parsed once.
    """
    prepare(spark)
    rows = engagement.validate(read_lines(spark, input_path, with_source=True), zone=zone, on_crash=on_crash)
    seen = Observation()
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in engagement.REASONS]
    rows = rows.observe(
        seen, F.count("*").alias("lines"), F.count_if(F.col("reason").isNull()).alias("valid"), *counts
    )
    if rejects_path is not None:
        rows = land(spark, rows, "engagement-judged")
        write_parquet(engagement.rejected(rows), rejects_path, mode=mode)
    write_avro(engagement.accepted(rows), output_path, ENGAGEMENT_AVRO, codec, shards, mode)
    return seen.get


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input_path", required=True, nargs="+")
    parser.add_argument("--output_path", required=True)
    parser.add_argument("--rejects_path")
    parser.add_argument("--zone", default="UTC")
    parser.add_argument("--on_crash", choices=["reject", "fail"], default="reject")
    parser.add_argument("--shards", type=int)
    parser.add_argument("--manifest_path", help="append the completion message to this Parquet folder")
    parser.add_argument("--bootstrap_servers", help="send the completion message to these brokers")
    parser.add_argument("--topic", default="fan-engagement")
    parser.add_argument("--split_mb", type=int, help="megabytes of input per task")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("engagement-batch").getOrCreate()
    scan_task_size(spark, args.split_mb)
    outcome = run(
        spark,
        args.input_path,
        args.output_path,
        args.rejects_path,
        args.zone,
        args.on_crash,
        shards=args.shards,
    )
    for name, rows in outcome.items():
        if rows:
            print(f"{name}: {rows}")
    done = manifest(
        spark, [Output("FanEngagement", None, args.output_path, "deflate", "avro")], "engagement-batch"
    )
    if args.manifest_path:
        write_parquet(done, args.manifest_path, mode="append")
    if args.bootstrap_servers:
        write_kafka(done, args.bootstrap_servers, args.topic)


if __name__ == "__main__":
    main()
