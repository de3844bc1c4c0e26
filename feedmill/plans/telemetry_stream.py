"""Telemetry streaming job: lines with diagnostics to gzip Parquet, endlessly."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from feedmill.operators.telemetry import STREAM
from feedmill.session import prepare
from feedmill.sources import stream_kafka_lines, stream_lines
from feedmill.streaming import start_critical, start_split
from feedmill.streaming.published import start_published


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap_servers", help="Kafka brokers, host:port")
    source.add_argument("--input_path", help="folder in which files of JSON lines arrive")
    parser.add_argument("--topic", help="Kafka topic")
    parser.add_argument("--output_path", required=True)
    parser.add_argument("--checkpoint_path", required=True)
    parser.add_argument("--rejects_path", help="also keep the rejected lines here")
    parser.add_argument(
        "--publish", action="store_true", help="both routes and the rejects under output_path, seen together by readers"
    )
    parser.add_argument("--conformance", action="store_true", help="with --publish: keep counters and sketches of every batch")
    parser.add_argument("--every", default="1 minute", help="micro-batch interval")
    parser.add_argument("--shards", type=int, help="files per micro-batch; one per task by default")
    parser.add_argument("--enriched", action="store_true")
    parser.add_argument("--zone", default="UTC")
    args = parser.parse_args()
    if args.publish and (args.rejects_path or args.enriched):
        parser.error("--publish keeps the rejects itself; derived columns are worked out at reading")
    if args.conformance and not args.publish:
        parser.error("--conformance needs --publish")
    if args.bootstrap_servers and not args.topic:
        parser.error("--bootstrap_servers needs --topic")

    spark = prepare(SparkSession.builder.appName("telemetry-stream").getOrCreate())
    if args.bootstrap_servers:
        lines = stream_kafka_lines(spark, args.bootstrap_servers, args.topic)
    else:
        lines = stream_lines(spark, args.input_path)
    if args.publish:
        query = start_published(
            lines, args.output_path, args.checkpoint_path, args.every, args.zone, args.shards, args.conformance
        )
    elif args.rejects_path:
        query = start_split(
            lines,
            {STREAM: args.output_path},
            args.rejects_path,
            args.checkpoint_path,
            args.every,
            args.enriched,
            args.zone,
            args.shards,
        )
    else:
        query = start_critical(
            lines, args.output_path, args.checkpoint_path, args.every, args.shards, args.enriched, args.zone
        )
    query.awaitTermination()


if __name__ == "__main__":
    main()
