"""Telemetry batch job: JSON lines without diagnostics to gzip Parquet."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedmill.operators import telemetry
from feedmill.operators.quality import Output, manifest
from feedmill.plans import land
from feedmill.session import prepare, scan_task_size
from feedmill.sinks import write_parquet
from feedmill.sources import read_lines, read_parquet


def run(
    spark: SparkSession,
    input_path: str | list[str],
    output_path: str,
    rejects_path: str | None = None,
    enriched: bool = False,
    zone: str = "UTC",
    shards: int | None = None,
    codec: str = "GZIP",
    mode: str = "errorifexists",
) -> dict[str, int]:
    """Write the batch route, and the rejects if a folder is given for them.

    Gives the lines seen and the rows per outcome, counted during the write.
    Either way every line is parsed once.
    """
    prepare(spark)
    rows = telemetry.flatten(read_lines(spark, input_path, with_source=True), zone=zone)
    seen = Observation()
    counts = [F.count_if((F.col("route") == r) & F.col("reason").isNull()).alias(r) for r in ("batch", "stream")]
    counts += [F.count_if(F.col("reason") == r).alias(r) for r in telemetry.REASONS]
    rows = rows.observe(seen, F.count("*").alias("lines"), *counts)
    if rejects_path is not None:
        wanted = F.col("reason").isNotNull() | (F.col("route") == telemetry.BATCH)
        rows = land(spark, rows.where(wanted), "telemetry-judged")
        write_parquet(telemetry.rejected(rows), rejects_path, codec, mode=mode)
    write_parquet(telemetry.accepted(rows, telemetry.BATCH, enriched), output_path, codec, shards, mode)
    return seen.get


def count_output(spark: SparkSession, output_path: str) -> int | None:
    """Rows of the written output, or None when there are no files."""
    from pyspark.errors import AnalysisException

    try:
        return read_parquet(spark, output_path).count()
    except AnalysisException:
        return None


def run_manifest(spark: SparkSession, output_path: str, codec: str = "GZIP") -> DataFrame:
    return manifest(spark, [Output("VehicleTelemetry", telemetry.BATCH, output_path, codec)], "telemetry-batch")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input_path", required=True, nargs="+", help="files, folders or globs of JSON lines")
    parser.add_argument("--output_path", required=True)
    parser.add_argument("--rejects_path")
    parser.add_argument("--enriched", action="store_true", help="store the derived columns too")
    parser.add_argument("--zone", default="UTC", help="zone of timestamps without an offset")
    parser.add_argument("--shards", type=int, help="number of output files; one per task by default")
    parser.add_argument("--split_mb", type=int, help="megabytes of input per task")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("telemetry-batch").getOrCreate()
    scan_task_size(spark, args.split_mb)
    outcome = run(
        spark, args.input_path, args.output_path, args.rejects_path, args.enriched, args.zone, args.shards
    )
    for name, rows in outcome.items():
        if rows:
            print(f"{name}: {rows}")
    written = count_output(spark, args.output_path)
    print("no Parquet files under the output path" if written is None else f"rows written: {written}")


if __name__ == "__main__":
    main()
