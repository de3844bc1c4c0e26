"""A published stream under faults, its compaction and its readers."""

import collections

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from feedmill.operators import telemetry
from feedmill.sources import read_lines, stream_lines
from feedmill.streaming import published
from tests.test_jobs import TEXTS, _feed


class Fault(Exception):
    pass


def bag(frame):
    return collections.Counter(map(repr, frame.collect()))


@pytest.fixture
def feed(tmp_path):
    for k in range(4):
        _feed(tmp_path / "feed", TEXTS[k:] + TEXTS[:k], f"{k}.json")
    return str(tmp_path / "feed")


def expected(spark, feed):
    rows = telemetry.flatten(read_lines(spark, feed))
    kinds = {r: telemetry.accepted(rows, r) for r in (telemetry.BATCH, telemetry.STREAM)}
    return {k: bag(df) for k, df in (kinds | {published.REJECTS: telemetry.rejected(rows).select("line", "route", "reason")}).items()}


def seen(spark, root):
    return {k: bag(published.read_published(spark, root, k)) for k in (telemetry.BATCH, telemetry.STREAM, published.REJECTS)}


def run(spark, feed, root, state, step=lambda name, batch_id: None, lines=None):
    lines = stream_lines(spark, feed, max_files=1) if lines is None else lines
    published.start_published(lines, root, state, step=step, shards=1).awaitTermination()


def once(name, batch):
    def step(now, batch_id):
        if (now, batch_id) == (name, batch):
            raise Fault(name)

    return step


def test_a_stream_that_dies_and_restarts_equals_a_clean_run(spark, feed, tmp_path):
    root, state = str(tmp_path / "out"), str(tmp_path / "state")
    # A task fails, then the driver between the two writes, then behind them.
    broken = stream_lines(spark, feed, max_files=1)
    bad = F.when(F.rand(1) >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("value"))
    with pytest.raises(StreamingQueryException):
        run(spark, feed, root, state, lines=broken.select(bad.cast("string").alias("value")))
    with pytest.raises(ValueError, match="nothing is published"):
        published.read_published(spark, root)
    with pytest.raises(StreamingQueryException):
        run(spark, feed, root, state, once("written", 1))
    (first,) = published.folders(spark, root)
    # No reader sees a part of the second batch: its folder is there, its record is not.
    assert len(list((tmp_path / "out" / "data").iterdir())) == 2
    half = sum(sum(b.values()) for b in seen(spark, root).values())
    assert half == len(TEXTS)
    with pytest.raises(StreamingQueryException):
        run(spark, feed, root, state, once("committed", 2))
    assert len(published.folders(spark, root)) == 3
    run(spark, feed, root, state)
    assert seen(spark, root) == expected(spark, feed)
    assert len(published.folders(spark, root)) == 4 and first in published.folders(spark, root)
    # Draining again adds nothing.
    run(spark, feed, root, state)
    assert len(published.folders(spark, root)) == 4


def test_a_record_that_was_cut_short_is_not_seen_and_made_anew(spark, feed, tmp_path):
    root, state = str(tmp_path / "out"), str(tmp_path / "state")
    with pytest.raises(StreamingQueryException):
        run(spark, feed, root, state, once("committed", 3))
    record = max((tmp_path / "out" / "commits").glob("*.json"))
    record.write_text(record.read_text()[:20])
    (record.parent / f".{record.name}.crc").unlink()
    assert len(published.folders(spark, root)) == 3
    run(spark, feed, root, state)
    assert seen(spark, root) == expected(spark, feed)


def test_compaction_shows_equal_rows_before_during_and_after(spark, feed, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    run(spark, feed, root, str(tmp_path / "state"))
    want, held = expected(spark, feed), published.read_published(spark, root, telemetry.BATCH)
    during = {}
    commit = published._commit

    def watched(*args, **kwargs):
        during.update(seen(spark, root))
        return commit(*args, **kwargs)

    monkeypatch.setattr(published, "_commit", watched)
    assert published.compact(spark, root) == 4
    assert seen(spark, root) == want == during and bag(held) == want[telemetry.BATCH]
    assert len(published.folders(spark, root)) == 1
    files = list((tmp_path / "out" / published.folders(spark, root)[0]).rglob("*.parquet"))
    assert len(files) == 3
    assert published.compact(spark, root) == 0
    # Old folders stay for those who still read them, until they are old enough.
    assert published.vacuum(spark, root) == 0 and bag(held) == want[telemetry.BATCH]
    assert published.vacuum(spark, root, older_than_s=-1) == 4
    assert seen(spark, root) == want


def test_of_two_compactions_one_gives_up(spark, feed, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    run(spark, feed, root, str(tmp_path / "state"))
    commit = published._commit

    def overtaken(*args, **kwargs):
        monkeypatch.setattr(published, "_commit", commit)
        assert published.compact(spark, root) == 4
        return commit(*args, **kwargs)

    monkeypatch.setattr(published, "_commit", overtaken)
    assert published.compact(spark, root) == 0
    assert seen(spark, root) == expected(spark, feed)


def test_two_streams_publish_to_one_root(spark, feed, tmp_path):
    root = str(tmp_path / "out")
    for name in ("a", "b"):
        run(spark, feed, root, str(tmp_path / name))
    want = expected(spark, feed)
    assert seen(spark, root) == {k: b + b for k, b in want.items()}
