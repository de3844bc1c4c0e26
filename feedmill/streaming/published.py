"""Both routes and the rejects of a stream, seen together or not at all.

A micro-batch is parsed once and written by one job to a folder of its own, with
the route as partition. Readers do not list folders: they see what commit records
name. A record is one small file, made after the folder is complete and refused if
it is there already. So a batch that dies before its record leaves only a folder
that nobody reads, and is written anew; one that dies after it is passed over when
the stream runs it again. Every line lands exactly once, in all outputs at the
same moment.

With ``conformance`` a batch's counters (``operators/quality.py``) are written beside it
before its record is made, and seen with it. They fold to the report of all rows, and
stay when the rows are compacted.

Small files of many batches are rewritten by ``compact``: its record adds the new
folder and drops the old ones in one step. ``vacuum`` deletes what is not read any
more.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedmill.operators import telemetry
from feedmill.operators.quality import conformance_counters
from feedmill.stores import create_json, exists, place, read_json

REJECTS = "rejects"
_FOLDER = "written"
_RECORDS = "commits"
_COUNTERS = "conformance"
_COMPACTED = "compact-"
_RECORD = "adds array<string>, drops array<string>"

#: Called as ``step(name, batch_id)`` when a batch is ``written`` and when it is ``committed``.
Step = Callable[[str, int], None]


def _commit(spark: SparkSession, root: str, name: str, adds: list[str], drops: list[str], renew: bool = False) -> bool:
    """Make a record; False if another writer made it first. ``renew`` replaces a part of one."""
    return create_json(spark, f"{root}/{_RECORDS}/{name}.json", {"adds": adds, "drops": drops}, renew)


def _records(spark: SparkSession, root: str) -> list[tuple[str, list[str], list[str]]]:
    """File, added and dropped folders of every whole record: one a batch since the last ``vacuum``."""
    there, store = place(spark, f"{root}/{_RECORDS}")
    if not store.exists(there):
        return []
    rows = spark.read.schema(_RECORD).json(f"{root}/{_RECORDS}").select("*", F.col("_metadata.file_name").alias("file"))
    return [(r["file"], r["adds"], r["drops"]) for r in rows.where("adds IS NOT NULL AND drops IS NOT NULL").collect()]


def folders(spark: SparkSession, root: str) -> list[str]:
    """The folders that readers see now."""
    records = _records(spark, root)
    dropped = {f for _, _, drops in records for f in drops}
    return sorted({f for _, adds, _ in records for f in adds} - dropped)


def _rows(spark: SparkSession, root: str, found: list[str]) -> DataFrame:
    rows = spark.read.option("basePath", f"{root}/data").parquet(*[f"{root}/{f}" for f in found])
    return rows.drop(_FOLDER)


def read_published(spark: SparkSession, root: str, kind: str | None = None) -> DataFrame:
    """Rows of one route, or the rejects, or all with their ``kind``, as of now.

    The folders are fixed when this is called, so a frame goes on giving the same
    rows while batches are added or files compacted.
    """
    found = folders(spark, root)
    if not found:
        raise ValueError(f"nothing is published at {root}")
    rows = _rows(spark, root, found)
    if kind is None:
        return rows
    rows = rows.where(F.col("kind") == kind)
    if kind == REJECTS:
        return rows.select("line", "route", "reason")
    return rows.select(*telemetry.FLAT_COLUMNS)


def _counters(folder: str) -> str:
    return f"{_COUNTERS}/{folder.removeprefix('data/')}"


def read_conformance(spark: SparkSession, root: str) -> DataFrame:
    """The counters of every batch published so far, with its name as ``written``; to be folded, or compared in spans.

    All batches must have been published with ``conformance``, or the report would not be whole.
    """
    batches = [f for file, adds, _ in _records(spark, root) if not file.startswith(_COMPACTED) for f in adds]
    if not batches:
        raise ValueError(f"nothing is published at {root}")
    found = [f"{root}/{_counters(f)}" for f in sorted(batches)]
    without = [f for f in found if not exists(spark, f)]
    if without:
        raise ValueError(f"published without counters: {', '.join(without[:3])}")
    return spark.read.option("basePath", f"{root}/{_COUNTERS}").parquet(*found)


def start_published(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = None,
    zone: str = "UTC",
    shards: int | None = None,
    conformance: bool = False,
    step: Step = lambda name, batch_id: None,
) -> StreamingQuery:
    """Publish both routes and the rejects of a stream of lines under ``root``.

    One stream writes under a checkpoint; others may publish to the same root.
    ``shards`` fixes the files of a batch's kinds. ``conformance`` keeps counters of the
    good rows, read off the written columns. ``step`` is told how far a
    batch is, and may stop it by raising.
    """
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{stream}-{batch_id:010d}"
        record = read_json(spark, f"{root}/{_RECORDS}/{name}.json")
        if record is not None:
            return
        rows = telemetry.flatten(batch, zone=zone)
        good = F.col("reason").isNull()
        rows = rows.withColumn("kind", F.when(good, F.col("route")).otherwise(REJECTS)).withColumn(
            "line", F.when(~good, F.col("line"))
        )
        if shards is not None:
            rows = rows.repartition(shards)
        folder = f"data/{_FOLDER}={name}-{uuid.uuid4().hex}"
        rows.write.partitionBy("kind").option("compression", "gzip").parquet(f"{root}/{folder}")
        if conformance:
            good_rows = spark.read.schema(rows.schema).parquet(f"{root}/{folder}").where(F.col("kind") != REJECTS)
            conformance_counters(good_rows).write.parquet(f"{root}/{_counters(folder)}")
        step("written", batch_id)
        _commit(spark, root, name, [folder], [], renew=True)
        step("committed", batch_id)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def compact(spark: SparkSession, root: str, target_mb: int = 128) -> int:
    """Rewrite folders of small files as files of some ``target_mb``; how many folders were replaced.

    Small: the files of a folder have less than half the target on average. Scan
    tasks that read neighbouring files write them, without a shuffle. Readers see
    the old folders until the record is made, and the new one from then on. Of two
    compactions at a time the later one gives up.
    """
    target = target_mb * 1024 * 1024
    number = sum(file.startswith(_COMPACTED) for file, _, _ in _records(spark, root))
    small, size = [], 0
    for folder in folders(spark, root):
        there, store = place(spark, f"{root}/{folder}")
        about = store.getContentSummary(there)
        if about.getLength() < target / 2 * max(1, about.getFileCount()):
            small.append(folder)
            size += about.getLength()
    if len(small) < 2:
        return 0
    rows = _rows(spark, root, small)
    folder = f"data/{_FOLDER}={_COMPACTED}{uuid.uuid4().hex}"
    written = rows.coalesce(max(1, -(-size // target))).write.partitionBy("kind").option("compression", "gzip")
    written.parquet(f"{root}/{folder}")
    return len(small) if _commit(spark, root, f"{_COMPACTED}{number:010d}", [folder], small) else 0


def vacuum(spark: SparkSession, root: str, older_than_s: float = 7 * 24 * 3600) -> int:
    """Delete folders that no record shows any more, and that no reader of the last ``older_than_s`` seconds can hold.

    Folders of batches that died go too, and their counters. Records and the counters of
    published batches stay: they are small, and say what a batch that is run again has done.
    """
    there, store = place(spark, f"{root}/data")
    shown, before = set(folders(spark, root)), (time.time() - older_than_s) * 1000
    # The last records made: a folder may be dropped long after it was written.
    dropped_at, counted = {}, set()
    for file, adds, drops in _records(spark, root):
        counted |= {_counters(f) for f in adds}
        made = store.getFileStatus(place(spark, f"{root}/{_RECORDS}/{file}")[0]).getModificationTime()
        dropped_at |= {f: max(made, dropped_at.get(f, 0)) for f in drops}
    gone = 0
    for status in store.listStatus(there):
        folder = f"data/{status.getPath().getName()}"
        if folder not in shown and max(status.getModificationTime(), dropped_at.get(folder, 0)) < before:
            gone += store.delete(status.getPath(), True)
    there, _ = place(spark, f"{root}/{_COUNTERS}")
    for status in store.listStatus(there) if store.exists(there) else []:
        if f"{_COUNTERS}/{status.getPath().getName()}" not in counted and status.getModificationTime() < before:
            store.delete(status.getPath(), True)
    return gone
