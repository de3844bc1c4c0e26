"""Jobs end to end: batch and stream agree, rejects and manifests add up."""

import json

from pyspark.sql import functions as F

from feedmill.operators import engagement, quality, telemetry
from feedmill.plans import engagement_batch, telemetry_batch
from feedmill.sinks import kafka_messages, output_name, write_json_lines
from feedmill.sources import read_avro, read_lines, read_parquet, stream_lines, utf8_text
from feedmill.streaming import start_critical, start_split
from tests.test_engagement import REASON_CASES as FAN_CASES
from tests.test_telemetry import REASON_CASES, variant, PLAIN


def _feed(folder, texts, name):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n", encoding="utf-8")


TEXTS = [text for text, _ in REASON_CASES] + [variant(PLAIN), variant(), variant(PLAIN)]


def _bag(frame):
    return sorted(map(repr, frame.select(*telemetry.FLAT_COLUMNS).collect()))


def test_batch_job_streams_and_split_agree(spark, tmp_path):
    feed = tmp_path / "feed"
    _feed(feed, TEXTS, "a.json")
    _feed(feed, TEXTS[::-1], "b.json")
    outcome = telemetry_batch.run(spark, f"{feed}/*.json", str(tmp_path / "batch"), str(tmp_path / "rejects"))
    assert outcome["lines"] == 2 * len(TEXTS)
    assert outcome["batch"] == telemetry_batch.count_output(spark, str(tmp_path / "batch")) > 0
    assert sum(n for name, n in outcome.items() if name != "lines") == outcome["lines"]
    rejects = read_parquet(spark, str(tmp_path / "rejects"))
    assert rejects.count() == sum(outcome[r] for r in telemetry.REASONS)
    assert rejects.where(F.col("source_file").endswith("b.json")).count() * 2 == rejects.count()
    counts = {(r["route"], r["reason"]): r["rows"] for r in quality.reject_counts(rejects).collect()}
    assert counts[(None, "json")] == outcome["json"]

    critical = start_critical(stream_lines(spark, str(feed)), str(tmp_path / "critical"), str(tmp_path / "c1"), shards=1)
    critical.awaitTermination()
    outputs = {route: str(tmp_path / f"split-{route}") for route in ("batch", "stream")}
    split = start_split(
        stream_lines(spark, str(feed), max_files=1), outputs, str(tmp_path / "split-rejects"), str(tmp_path / "c2"), shards=1
    )
    split.awaitTermination()
    for folder in (tmp_path / "split-stream").glob("batch_id=*"):
        assert len(list(folder.glob("*.parquet"))) == 1
    assert _bag(read_parquet(spark, outputs["batch"])) == _bag(read_parquet(spark, str(tmp_path / "batch")))
    assert _bag(read_parquet(spark, outputs["stream"])) == _bag(read_parquet(spark, str(tmp_path / "critical")))
    assert read_parquet(spark, str(tmp_path / "critical")).count() == outcome["stream"]
    assert len(read_parquet(spark, str(tmp_path / "critical")).columns) == 41
    assert read_parquet(spark, str(tmp_path / "split-rejects")).count() == rejects.count()

    # Draining again with the same checkpoint adds nothing.
    start_critical(stream_lines(spark, str(feed)), str(tmp_path / "critical"), str(tmp_path / "c1")).awaitTermination()
    assert read_parquet(spark, str(tmp_path / "critical")).count() == outcome["stream"]

    (message,) = telemetry_batch.run_manifest(spark, str(tmp_path / "batch")).collect()
    assert (message["status"], message["rows"], message["route"]) == ("success", outcome["batch"], "batch")
    files = quality.file_metadata(spark, str(tmp_path / "batch")).collect()
    assert sum(f["rows"] for f in files) == outcome["batch"] and all(f["file_size"] > 0 for f in files)


def test_no_output_is_told_apart_from_an_empty_one(spark, tmp_path):
    assert telemetry_batch.count_output(spark, str(tmp_path / "nothing")) is None


def test_engagement_job(spark, tmp_path):
    _feed(tmp_path / "in", [text for text, _ in FAN_CASES], "fans.json")
    outcome = engagement_batch.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "bad"), shards=1)
    good = [reason for _, reason in FAN_CASES if reason is None]
    assert outcome["valid"] == len(good) == read_avro(spark, str(tmp_path / "out")).count()
    assert read_avro(spark, str(tmp_path / "out")).columns == engagement.COLUMNS
    assert read_parquet(spark, str(tmp_path / "bad")).count() == len(FAN_CASES) - len(good)
    assert len(list((tmp_path / "out").glob("*.avro"))) == 1


def test_conformance_counts(spark, lines):
    rows = telemetry.flatten(lines([variant(), variant(Engine_RPM=99), variant(Gear_Engaged="Park"), variant(PLAIN)]))
    report = {r["column_name"]: r for r in quality.conformance(telemetry.accepted(rows)).collect()}
    assert len(report) == 41 and report["engine_rpm"]["below"] == 1 and report["engine_rpm"]["above"] == 0
    assert report["gear_engaged"]["outside"] == 1 and report["gear_engaged"]["below"] is None
    assert report["engine_temp_c"]["nulls"] == 1 and report["vehicle_id"]["rows"] == 4


def test_json_lines_and_messages(spark, tmp_path):
    frame = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, 'ñ\"x' AS `c d`")
    write_json_lines(frame, str(tmp_path / "j"))
    (line,) = read_lines(spark, str(tmp_path / "j")).collect()
    assert json.loads(line["value"]) == {"a": 1, "b": None, "c d": 'ñ"x'}
    (message,) = kafka_messages(frame).collect()
    assert len(message["key"]) == 36 and json.loads(message["value"])["c d"] == 'ñ"x'
    payloads = spark.createDataFrame([(b"caf\xc3\xa9",), (b"\xff\xfe",)], "value binary")
    assert [r[0] for r in payloads.select(utf8_text(F.col("value"))).collect()] == ["café", None]


def test_output_names():
    assert output_name("data/x.csv", "out", "GZIP", "parquet") == "out/x.csv.GZIP.parquet"
