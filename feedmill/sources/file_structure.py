"""Rows, blocks and codecs of written files, from their structure alone.

A Parquet footer says how many rows its file has, the head of an Avro block how many
records follow and how long they are. So written files are counted, and seen to be
whole, without a page or a block being read. Large Avro files are walked in byte
ranges: a block belongs to the range in which the sync mark before it begins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.stores import place

FORMATS = ("parquet", "avro")

# Spark's names of stores, and those of the library that opens files inside tasks (fixed values).
_SCHEMES = {"file": "file", "s3": "s3", "s3a": "s3", "gs": "gs"}
# Object stores answer requests slowly and then send fast, so that reading on beats many small reads.
_WINDOW = {"file": 0, "s3": 4 << 20, "gs": 4 << 20}

# The beginning of an Avro container file, and the length of its sync mark.
_MAGIC = b"Obj\x01"
_MARK = 16
# Two numbers of at most ten bytes stand before a block.
_HEAD = 20

_PARTS = "output int, file string, codec string, blocks bigint, rows bigint, bytes bigint, bytes_read bigint"


def knows(spark: SparkSession, path: str) -> bool:
    """Can files of this path be opened inside tasks?"""
    return place(spark, path)[1].getUri().getScheme() in _SCHEMES


@lru_cache(maxsize=64)
def _store(scheme: str, host: str) -> tuple[fs.FileSystem, str]:
    if scheme == "file":
        return fs.LocalFileSystem(), ""
    store, base = fs.FileSystem.from_uri(f"{scheme}://{host}")
    return store, base.rstrip("/")


class _File:
    """A file, read at any place; counts what it reads."""

    def __init__(self, path: str) -> None:
        scheme, _, rest = path.partition(":")
        host = ""
        if rest.startswith("//"):
            host, _, rest = rest[2:].partition("/")
            rest = f"/{rest}"
        kind = _SCHEMES[scheme]
        store, base = _store(kind, host)
        self.path, self.window, self.bytes_read = path, _WINDOW[kind], 0
        self._at, self._held = 0, b""
        self.file = store.open_input_file(base + rest)
        self.size = self.file.size()

    def read(self, at: int, length: int) -> bytes:
        """Bytes from a place on; fewer only at the end of the file."""
        length = max(0, min(length, self.size - at))
        if not self._at <= at <= at + length <= self._at + len(self._held):
            self.file.seek(at)
            self._at, self._held = at, self.file.read(max(length, self.window))
            self.bytes_read += len(self._held)
        return self._held[at - self._at : at - self._at + length]


def _number(data: bytes, at: int) -> tuple[int, int]:
    """A zigzag number of seven bits a byte, and where it ends."""
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return (value >> 1) ^ -(value & 1), at


def _avro_head(file: _File) -> tuple[str, bytes, int]:
    """Codec, sync mark, and where the mark behind the header begins."""
    size = 1 << 12
    while True:
        data = file.read(0, size)
        if not data.startswith(_MAGIC):
            raise ValueError(f"{file.path}: not an Avro container file")
        try:
            found, at = {}, len(_MAGIC)
            while (count := _number(data, at))[0]:
                count, at = count
                if count < 0:
                    # A count below zero is followed by the length of its entries.
                    count, at = -count, _number(data, at)[1]
                for _ in range(count):
                    pair = []
                    for _ in range(2):
                        length, at = _number(data, at)
                        pair.append(data[at : at + length])
                        at += length
                    found[pair[0]] = pair[1]
            at = count[1]
            mark = data[at : at + _MARK]
            if len(mark) == _MARK:
                return found.get(b"avro.codec", b"null").decode(), mark, at
        except IndexError:
            pass
        if size >= file.size:
            raise ValueError(f"{file.path}: ends within its header")
        size *= 4


def _find(file: _File, mark: bytes, start: int, end: int) -> int:
    """The first place in ``[start, end)`` where the mark begins, or -1."""
    step = 1 << 8
    while start < end:
        data = file.read(start, min(step, end - start) + _MARK - 1)
        found = data.find(mark)
        if found >= 0:
            return start + found
        start, step = start + step, min(step * 4, 1 << 20)
    return -1


def _avro_range(file: _File, start: int, end: int) -> tuple[str, int, int]:
    """Codec, blocks and rows of one range; every block is stepped over, and the mark behind it compared."""
    codec, mark, first = _avro_head(file)
    at = _find(file, mark, max(start, first), min(end, file.size))
    blocks = rows = 0
    while 0 <= at < end and at + _MARK < file.size:
        head = at + _MARK
        data = file.read(head, _HEAD)
        try:
            count, used = _number(data, 0)
            length, used = _number(data, used)
        except IndexError:
            raise ValueError(f"{file.path}: ends within the block at byte {head}") from None
        at = head + used + length
        if count < 0 or length < 0 or file.read(at, _MARK + _HEAD)[:_MARK] != mark:
            raise ValueError(f"{file.path}: the block at byte {head} is damaged or cut short")
        blocks, rows = blocks + 1, rows + count
    return codec, blocks, rows


def _parquet_footer(file: _File) -> tuple[str, int, int]:
    footer = pq.read_metadata(file.file)
    file.bytes_read += footer.serialized_size + 8
    codecs = set()
    if footer.num_row_groups:
        group = footer.row_group(0)
        codecs = {group.column(k).compression.lower() for k in range(group.num_columns)}
    return ",".join(sorted(codecs)), footer.num_row_groups, footer.num_rows


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in _PARTS.split(", ")]
    for ranges in frames:
        rows = []
        for r in ranges.itertuples():
            file = _File(r.path)
            with file.file:
                found = _parquet_footer(file) if r.format == "parquet" else _avro_range(file, r.start, r.end)
                rows.append((r.output, r.path, *found, r.length if r.start == 0 else 0, file.bytes_read))
        yield pd.DataFrame(rows, columns=names)


def file_structure(spark: SparkSession, outputs: list[tuple[str, str]], split_mb: float = 256) -> DataFrame:
    """``output, file, codec, blocks, rows, bytes, bytes_read``, a row per file of each ``(path, format)``.

    ``output`` is the place of the pair in the list; ``codec`` that of the file itself, ``bytes_read``
    what was read of its ``bytes``. Files in sub-folders count; a folder without any gives no row.
    The job stops at a file that is no such container, is cut short or has a damaged block.
    """
    split = int(split_mb * 1024 * 1024)
    every = None
    for number, (path, format) in enumerate(outputs):
        if format not in FORMATS or not knows(spark, path):
            raise ValueError(f"the structure of {format!r} files at {path} cannot be read")
        # Paths and lengths come from the listing: without its content column this source opens no file.
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{format}")
        found = found.load(path).select(F.lit(number).alias("output"), F.lit(format).alias("format"), "path", "length")
        every = found if every is None else every.unionAll(found)
    if every is None:
        raise ValueError("no output to read")
    last = F.when(F.col("format") == "avro", F.greatest(F.col("length") - 1, F.lit(0))).otherwise(0).cast("long")
    ranges = every.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(split).cast("long"))))
    ranges = ranges.withColumn("end", F.col("start") + split)
    spread = ranges.repartition(spark.sparkContext.defaultParallelism, "path", "start")
    sums = [F.sum(c).alias(c) for c in ("blocks", "rows", "bytes", "bytes_read")]
    return spread.mapInPandas(_walk, _PARTS).groupBy("output", "file").agg(F.max("codec").alias("codec"), *sums)
