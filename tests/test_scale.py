"""What must not grow: tasks too few or too many, rows held or sorted, text written plain."""

import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as queries
import feedmill.streaming as streaming
from checks import feeds
from feedmill.operators import telemetry
from feedmill.sources import read_lines, read_parquet, stream_lines
from feedmill.streaming import published, start_split
from tests.test_telemetry import PLAIN, REASON_CASES, variant

EVENTS = 4000


@pytest.fixture
def tables(spark, tmp_path):
    """Events in one file of one row group."""
    events = spark.range(0, EVENTS, 1, 1).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("ts"),
        (F.col("id") % 50).alias("user_id"),
        F.lit("click").alias("event_type"),
        (F.col("id") / 7).alias("value"),
        F.lit("{}").alias("props"),
    )
    events.write.parquet(str(tmp_path / "tables" / "events.parquet"))
    return str(tmp_path / "tables")


def _bag(frame):
    return sorted(map(repr, frame.collect()))


def test_lines_of_a_small_scan_are_made_by_many_tasks(spark, tables, monkeypatch):
    for make in (feeds.telemetry_lines, feeds.fan_lines):
        assert make(spark, tables).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(feeds, "LINES_AT_ONCE", 100)
    assert feeds.telemetry_lines(spark, tables).rdd.getNumPartitions() == EVENTS // 100
    assert feeds.telemetry_lines(spark, tables).count() == EVENTS


def test_feed_files_are_compressed_and_hold_every_line(spark, tables):
    folder = feeds.feed_folder(spark, tables, "telemetry")
    files = read_lines(spark, folder).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
    assert _bag(read_lines(spark, folder)) == _bag(feeds.telemetry_lines(spark, tables))


def test_a_large_feed_is_published_in_few_batches(spark, tables, monkeypatch):
    monkeypatch.setattr(feeds, "LINES_AT_ONCE", 100)
    root = queries._published(spark, tables)
    assert 3 <= len(published._records(spark, root)) <= queries.BATCHES
    assert published.read_published(spark, root).count() == EVENTS


def test_split_holds_no_rows_and_no_lines_of_good_rows(spark, tmp_path, monkeypatch):
    (tmp_path / "feed").mkdir()
    texts = [text for text, _ in REASON_CASES] + [variant(PLAIN), variant()]
    (tmp_path / "feed" / "a.json").write_text("\n".join(texts) + "\n", encoding="utf-8")
    seen, drop = [], streaming.delete

    def delete(session, path):
        rows = read_parquet(session, path)
        seen.append((rows.count(), rows.where("reason IS NULL AND line IS NOT NULL").count()))
        assert session.sparkContext._jsc.getPersistentRDDs().isEmpty()
        return drop(session, path)

    monkeypatch.setattr(streaming, "delete", delete, raising=False)
    outputs = {r: str(tmp_path / r) for r in (telemetry.BATCH, telemetry.STREAM)}
    state = tmp_path / "state"
    start_split(stream_lines(spark, str(tmp_path / "feed")), outputs, str(tmp_path / "bad"), str(state)).awaitTermination()
    assert seen == [(len(texts), 0)] and not list(state.glob("judged/batch_id=*"))
    rejects = read_parquet(spark, str(tmp_path / "bad"))
    assert rejects.where("line IS NULL").count() == 0
    assert sum(read_parquet(spark, o).count() for o in outputs.values()) + rejects.count() == len(texts)


def test_compaction_and_published_batches_do_not_sort(spark, tables):
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    root = queries._published(spark, tables)
    rows = _bag(published.read_published(spark, root))
    assert published.compact(spark, root) >= 3
    assert _bag(published.read_published(spark, root)) == rows
    time.sleep(1)
    runs = store.executionsList()
    plans = [runs.apply(k).physicalPlanDescription() for k in range(int(before), runs.size())]
    writes = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and "kind" in p]
    assert writes and not [p for p in writes if "Sort" in p]


def test_ranges_of_a_large_csv_grow_with_it(spark, tables, monkeypatch):
    asked, ranges = [], queries._scan_ranges
    monkeypatch.setattr(queries, "_scan_ranges", lambda spark, size: asked.append(size) or ranges(spark, size))
    small = _bag(queries.quakes_split_csv(spark, tables))
    monkeypatch.setattr(queries, "RANGES", 2, raising=False)
    assert _bag(queries.quakes_split_csv(spark, tables)) == small and len(small) == EVENTS
    assert asked[0] == 64 < asked[1]
