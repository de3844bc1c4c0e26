"""Registered queries and their expected results in SQL.

Every query runs the library over a raw feed that Spark makes from the whole
``events`` table (``checks/feeds.py``); the SQL works out the same result from
``events`` alone, without reading the feed (``checks/oracle.py``).
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feeds
from checks.oracle import ORACLES
from feedmill.operators import engagement, quakes, telemetry
from feedmill.operators.quality import conformance, fold_conformance, manifest, reject_counts, route_counts
from feedmill.plans import engagement_batch, quake_convert, telemetry_batch
from feedmill.session import prepare, scratch_dir
from feedmill.sinks import kafka_messages, write_json_lines
from feedmill.sources import read_avro, read_lines, read_parquet, read_quake_csv, stream_lines
from feedmill.sources.file_structure import file_structure
from feedmill.stores import place
from feedmill.streaming import published, start_critical, start_split


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.flatten(feeds.telemetry_lines(prepare(spark), sf_dir))


def _zone_free(df: DataFrame) -> DataFrame:
    """Instants as UTC clock readings, so that no client zone touches them."""
    return df.withColumns(
        {
            name: F.col(name).cast("timestamp_ntz")
            for name, type_ in df.dtypes
            if type_ == "timestamp"
        }
    )


@contextmanager
def _scan_ranges(spark: SparkSession, kilobytes: int) -> Iterator[None]:
    """Scan tasks of about this size, so that small files have many ranges."""
    sizes = {"maxPartitionBytes": f"{kilobytes}k", "openCostInBytes": f"{kilobytes}k"}
    before = {key: spark.conf.get(f"spark.sql.files.{key}") for key in sizes}
    for key, value in sizes.items():
        spark.conf.set(f"spark.sql.files.{key}", value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(f"spark.sql.files.{key}", value)


#: Kilobytes of the compressed feed that one task scans: they hold some ten times as much text.
FEED_SCAN = 16 * 1024


def telemetry_flat_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry.flatten(feeds.telemetry_lines(prepare(spark), sf_dir), route=telemetry.BATCH)
    return _zone_free(telemetry.accepted(rows, telemetry.BATCH))


def telemetry_flat_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming job over the feed's files, read back from its Parquet output."""
    prepare(spark)
    out, state = scratch_dir(spark, "critical"), scratch_dir(spark, "critical-state")
    lines = stream_lines(spark, feeds.feed_folder(spark, sf_dir, "telemetry"))
    with _scan_ranges(spark, FEED_SCAN):
        start_critical(lines, out, state).awaitTermination()
    return _zone_free(read_parquet(spark, out))


def telemetry_stream_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both routes and the rejects from one stream; the good rows of both read back."""
    prepare(spark)
    outputs = {r: scratch_dir(spark, f"split-{r}") for r in (telemetry.BATCH, telemetry.STREAM)}
    lines = stream_lines(spark, feeds.feed_folder(spark, sf_dir, "telemetry"))
    with _scan_ranges(spark, FEED_SCAN):
        start_split(
            lines, outputs, scratch_dir(spark, "split-rejects"), scratch_dir(spark, "split-state")
        ).awaitTermination()
    parts = [
        read_parquet(spark, folder).select(*telemetry.FLAT_COLUMNS, F.lit(route).alias("route"))
        for route, folder in outputs.items()
    ]
    return _zone_free(parts[0].unionByName(parts[1]))


#: Batches of a large feed.
BATCHES = 6


def _published(spark: SparkSession, sf_dir: str, conformance: bool = False) -> str:
    """The feed published in several batches, the stream stopped twice on the way and restarted from its checkpoint.

    It stops when the second batch is written but not committed, and when the
    third is committed but its run not finished.
    """
    prepare(spark)
    root, state = scratch_dir(spark, "published"), scratch_dir(spark, "published-state")
    folder = feeds.feed_folder(spark, sf_dir, "telemetry")
    # Two files of a small feed; a large one has many files, and not more batches for it.
    max_files = max(2, -(-feeds.parts(spark, sf_dir) // BATCHES))

    def run(stop: tuple[str, int] | None) -> None:
        def step(name: str, batch_id: int) -> None:
            if (name, batch_id) == stop:
                raise InterruptedError(f"stopped when batch {batch_id} was {name}")

        try:
            lines = stream_lines(spark, folder, max_files=max_files)
            published.start_published(lines, root, state, step=step, conformance=conformance).awaitTermination()
        except StreamingQueryException as error:
            if stop is None or "InterruptedError" not in str(error):
                raise

    with _scan_ranges(spark, FEED_SCAN):
        for stop in (("written", 1), ("committed", 2), None):
            run(stop)
    return root


def _both_routes(spark: SparkSession, root: str) -> DataFrame:
    parts = [
        published.read_published(spark, root, route).withColumn("route", F.lit(route))
        for route in (telemetry.BATCH, telemetry.STREAM)
    ]
    return _zone_free(parts[0].unionByName(parts[1]))


def telemetry_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both routes as readers see them after a stream that died and was restarted."""
    return _both_routes(spark, _published(spark, sf_dir))


def telemetry_published_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects of the same stream, counted."""
    rows = published.read_published(spark, _published(spark, sf_dir), published.REJECTS)
    return reject_counts(rows).na.fill({"route": "none"})


def telemetry_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both routes after the stream's small files were rewritten, and the old ones deleted."""
    root = _published(spark, sf_dir)
    published.compact(spark, root)
    published.vacuum(spark, root, older_than_s=-1)
    return _both_routes(spark, root)


def telemetry_stream_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report folded from the counters of every batch, of a stream that died and was restarted, after compaction."""
    root = _published(spark, sf_dir, conformance=True)
    published.compact(spark, root)
    published.vacuum(spark, root, older_than_s=-1)
    return fold_conformance(published.read_conformance(spark, root))


def telemetry_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry.accepted(_rows(spark, sf_dir), enriched=True)
    return _zone_free(rows.withColumn("status_flags", F.array_join("status_flags", ",")))


def telemetry_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_counts(_rows(spark, sf_dir)).na.fill({"route": "none", "reason": "accepted"})


def telemetry_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(telemetry.rejected(_rows(spark, sf_dir))).na.fill({"route": "none"})


def telemetry_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformance(telemetry.accepted(_rows(spark, sf_dir)))


def telemetry_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job over the feed's files, read back from its Parquet output."""
    prepare(spark)
    out, feed = scratch_dir(spark, "batch"), feeds.feed_folder(spark, sf_dir, "telemetry")
    with _scan_ranges(spark, FEED_SCAN):
        telemetry_batch.run(spark, feed, out, scratch_dir(spark, "batch-rejects"))
    return _zone_free(read_parquet(spark, out))


def _fan_output(rows: DataFrame) -> DataFrame:
    columns = [
        F.unix_millis("Timestamp_unix").alias("Timestamp_unix_ms") if c == "Timestamp_unix" else F.col(c)
        for c in engagement.COLUMNS
    ]
    return rows.select(*columns)


def fan_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = engagement.validate(feeds.fan_lines(prepare(spark), sf_dir))
    return _fan_output(engagement.accepted(rows))


def fan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = engagement.validate(feeds.fan_lines(prepare(spark), sf_dir))
    return reject_counts(engagement.rejected(rows))


def fan_avro_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engagement job over the feed's files, read back from its Avro output."""
    prepare(spark)
    out = scratch_dir(spark, "fan-avro")
    engagement_batch.run(spark, feeds.feed_folder(spark, sf_dir, "fan"), out)
    return _fan_output(read_avro(spark, out))


def quakes_parquet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv = feeds.feed_folder(prepare(spark), sf_dir, "quakes3")
    return quakes.parquet_rows(read_quake_csv(spark, csv))


#: Ranges that a feed too large for 64 kilobytes each is cut into.
RANGES = 512


def quakes_split_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with quoted line breaks, converted by many tasks a file; read back from the Parquet output."""
    csv = feeds.feed_folder(prepare(spark), sf_dir, "quakes3")
    folder, store = place(spark, csv)
    with _scan_ranges(spark, max(64, store.getContentSummary(folder).getLength() // (1024 * RANGES))):
        path = quake_convert.convert(spark, csv, scratch_dir(spark, "quake-split"), "parquet", "SNAPPY", split=True)
    return read_parquet(spark, path)


def _quake_avro_output(rows: DataFrame) -> DataFrame:
    return rows.withColumn("UTC_Date_ms", F.unix_millis("UTC_Date")).drop("UTC_Date")


def quakes_avro_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv = feeds.feed_folder(prepare(spark), sf_dir, "quakes4")
    return _quake_avro_output(quakes.avro_rows(read_quake_csv(spark, csv)))


def quakes_avro_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv = feeds.feed_folder(prepare(spark), sf_dir, "quakes4")
    path = quake_convert.convert(spark, csv, scratch_dir(spark, "quake-avro"), "avro", "snappy")
    return _quake_avro_output(read_avro(spark, path))


def quakes_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven conversions, and the rows counted on each written output."""
    csv = feeds.feed_folder(prepare(spark), sf_dir, "quakes3")
    outputs = quake_convert.convert_all(spark, [csv], scratch_dir(spark, "quake-matrix"))
    counted = manifest(spark, outputs, "quake-convert")
    return counted.select(F.concat_ws(":", "format", "codec").alias("codec"), "rows")


def quakes_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codec and the rows that the files of all seven conversions show of themselves, and how little of them is read."""
    csv = feeds.feed_folder(prepare(spark), sf_dir, "quakes3")
    outputs = quake_convert.convert_all(spark, [csv], scratch_dir(spark, "quake-structure"))
    files = file_structure(spark, [(o.path, o.format) for o in outputs])
    kinds = F.array(*[F.lit(o.format) for o in outputs])
    sums = files.groupBy("output", "codec").agg(
        F.sum("rows").alias("rows"),
        # A head or footer a file, and a small share of the rest.
        (F.sum("bytes_read") < 8192 * F.count("*") + F.sum("bytes") / 10).alias("little_read"),
    )
    kind = F.element_at(kinds, F.col("output") + 1)
    return sums.select(F.concat_ws(":", kind, "codec").alias("codec"), "rows", "little_read")


_EVENT_FIELDS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON lines and read back."""
    prepare(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = write_json_lines(events, scratch_dir(spark, "events-jsonl"))
    return read_lines(spark, folder).select(F.from_json("value", _EVENT_FIELDS).alias("r")).select("r.*")


def kafka_messages_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as keyed messages, and the fields read out of the message text."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    messages = kafka_messages(events).where(F.length("key") == 36)
    return messages.select(F.from_json("value", _EVENT_FIELDS).alias("r")).select("r.*")


def _corpus_modules() -> tuple:
    """The corpus queries and pipeline where they are installed; what they import must be there if they are."""
    there = all(importlib.util.find_spec(name) for name in ("feedmill.llm", "corpus_pipeline"))
    if not there:
        return ()
    import corpus_pipeline
    from feedmill.llm import oracles
    from feedmill.llm import queries as corpus

    return corpus_pipeline, corpus, oracles


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: flat and derived telemetry columns from raw lines."""
    return telemetry_enriched(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "telemetry_flat_batch": telemetry_flat_batch,
        "telemetry_flat_stream": telemetry_flat_stream,
        "telemetry_stream_split": telemetry_stream_split,
        "telemetry_published": telemetry_published,
        "telemetry_published_rejects": telemetry_published_rejects,
        "telemetry_compacted": telemetry_compacted,
        "telemetry_stream_conformance": telemetry_stream_conformance,
        "telemetry_enriched": telemetry_enriched,
        "telemetry_routes": telemetry_routes,
        "telemetry_rejects": telemetry_rejects,
        "telemetry_conformance": telemetry_conformance,
        "telemetry_parquet_roundtrip": telemetry_parquet_roundtrip,
        "fan_valid": fan_valid,
        "fan_rejects": fan_rejects,
        "fan_avro_roundtrip": fan_avro_roundtrip,
        "quakes_parquet_rows": quakes_parquet_rows,
        "quakes_split_csv": quakes_split_csv,
        "quakes_avro_rows": quakes_avro_rows,
        "quakes_avro_roundtrip": quakes_avro_roundtrip,
        "quakes_matrix": quakes_matrix,
        "quakes_structure": quakes_structure,
        "jsonl_roundtrip": jsonl_roundtrip,
        "kafka_messages": kafka_messages_text,
    }
    for pipeline, corpus, _ in [m for m in [_corpus_modules()] if m]:
        found |= corpus.QUERIES | {"pipeline": pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLES)
    for pipeline, _, oracles in [m for m in [_corpus_modules()] if m]:
        found |= oracles.ORACLES
        if pipeline.ORACLE_SQL:
            found["pipeline"] = pipeline.ORACLE_SQL
    return found
