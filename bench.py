"""Time the headline queries over raw feeds; prints one JSON line.

The feeds are written to files first, outside the timing, so that a query is
scan, parse, judge and project, as in a real run. Warm session, median of three.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from checks import feeds
from feedmill.operators import engagement, quakes, telemetry
from feedmill.operators.quality import conformance, route_counts
from feedmill.plans import telemetry_batch
from feedmill.session import local_session, scratch_dir
from feedmill.sources import read_lines, read_quake_csv

RUNS = 3


def _drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _queries(spark: SparkSession, sf_dir: str) -> dict:
    lines = read_lines(spark, feeds.feed_folder(spark, sf_dir, "telemetry"))
    fans = read_lines(spark, feeds.feed_folder(spark, sf_dir, "fan"))
    csv = {n: read_quake_csv(spark, feeds.feed_folder(spark, sf_dir, f"quakes{n}")) for n in (3, 4)}
    rows = telemetry.flatten(lines)
    frames = {
        "telemetry_flat_batch": telemetry.accepted(telemetry.flatten(lines, route=telemetry.BATCH), telemetry.BATCH),
        "telemetry_flat_stream": telemetry.accepted(telemetry.flatten(lines, route=telemetry.STREAM), telemetry.STREAM),
        "telemetry_enriched": telemetry.accepted(rows, enriched=True),
        "telemetry_routes": route_counts(rows),
        "telemetry_conformance": conformance(telemetry.accepted(rows)),
        "fan_valid": engagement.accepted(engagement.validate(fans)),
        "quakes_parquet_rows": quakes.parquet_rows(csv[3]),
        "quakes_avro_rows": quakes.avro_rows(csv[4]),
    }
    timed = {name: (lambda df=df: _drain(df)) for name, df in frames.items()}
    timed["telemetry_batch_job"] = lambda: telemetry_batch.run(
        spark, feeds.feed_folder(spark, sf_dir, "telemetry"), scratch_dir(spark, "bench"), scratch_dir(spark, "bench-rejects")
    )
    return timed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    for name, run in _queries(spark, sf_dir).items():
        run()
        samples = []
        for _ in range(RUNS):
            started = time.perf_counter()
            run()
            samples.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(samples), 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "lines_per_feed": lines,
                "lines_per_second": {name: round(lines / s) for name, s in seconds.items()},
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
