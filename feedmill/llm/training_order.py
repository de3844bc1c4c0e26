"""Sequences in training order, as fixed-stride binary shards.

A keyed Feistel network permutes the numbers below a power of four; walking on
along its cycle while the number is too large makes it a permutation of exactly
``n`` numbers. So each sequence finds its slot in the shuffled epoch from its own
number and the key, and each slot its sequence by the network run backwards,
without sorting by a random column and without a table of the permutation.

First, tasks encode documents into token streams, one file a task; the files'
totals say where in the whole stream each begins, and sequence ``i`` is tokens
``[i * window, (i + 1) * window)``. Then a task takes a range of slots, a shard:
it asks for the sequence of every slot, reads those token ranges in the order in
which they lie in the streams, and writes the shard. Slot ``s`` lies in shard
``s // per_shard`` at byte ``(s % per_shard) * stride``: training reads on, and
resumes, with one seek. No row is shuffled; a task holds one shard.
"""

from __future__ import annotations

import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm.common import land, small_batches
from feedmill.llm.files import create, read_range, rename
from feedmill.llm.packing import END, ROWS_AT_ONCE, WINDOW, word_encoder
from feedmill.llm.token_counts import ship

ROUNDS = 6
#: Sequences in one shard.
PER_SHARD = 1024
PAD = 0
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def permute(numbers: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """Where each number below ``n`` goes, or with ``back`` where it comes from; a bijection of ``0 .. n - 1`` for every key."""
    half = max(1, ((max(n, 1) - 1).bit_length() + 1) // 2)
    mask = _U((1 << half) - 1)
    with np.errstate(over="ignore"):
        keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(key % 2**64))
        out = np.asarray(numbers).astype(np.uint64)
        walking = np.ones(len(out), dtype=bool)
        while walking.any():
            left, right = out[walking] >> _U(half), out[walking] & mask
            if back:
                for k in keys[::-1]:
                    left, right = right ^ (_mix(left + k) & mask), left
            else:
                for k in keys:
                    left, right = right, left ^ (_mix(right + k) & mask)
            out[walking] = (left << _U(half)) | right
            walking &= out >= _U(n)
    return out.astype(np.int64)


def _encode(name: str, folder: str, end: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_encoder(SparkFiles.get(name)), TaskContext.get().partitionId()
        # An attempt that fails leaves a file that no listing names.
        path, total, out = f"{folder}/{part:08d}-{uuid.uuid4().hex}.tokens", 0, None
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                _, ids = encoder.encode_rows(batch.slice(lo, ROWS_AT_ONCE).column("text"), end)
                if width < 4 and ids.max(initial=0) >= 1 << (8 * width):
                    raise ValueError("a token id does not fit the width of the shards")
                out = out or create(path)
                out.write(ids.astype(f"<u{width}").tobytes())
                total += len(ids)
        if out is not None:
            out.close()
            columns = [pa.array([part], pa.int32()), pa.array([path]), pa.array([total], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "path", "tokens"])

    return run


def streams(docs: DataFrame, tokenizer: str, folder: str, text: str = "text", end: int = END, width: int = 2) -> DataFrame:
    """Token streams of all documents in ``folder``; their listing: ``part, path, tokens``.

    A null or empty text is the end token alone; rows that repeat are written
    each; only the text is read. An empty table makes no stream.
    """
    small_batches(docs.sparkSession)
    name = ship(docs.sparkSession, tokenizer)
    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return land(rows.mapInArrow(_encode(name, folder, end, width), "part int, path string, tokens bigint"), "token-streams")


SCHEMA = "sequence_id bigint, slot bigint, shard bigint, byte_offset bigint, n_tokens bigint, record_crc32 bigint"


def _shards(sent, folder: str, key: int, window: int, per_shard: int, width: int) -> Callable:
    stride = window * width

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths, starts, total = sent.value
        n = -(-total // window)

        def tokens(at: int, count: int) -> bytes:
            parts, file = [], bisect_right(starts, at) - 1
            while count:
                last = starts[file + 1] if file + 1 < len(starts) else total
                here = min(count, last - at)
                parts.append(read_range(paths[file], (at - starts[file]) * width, here * width))
                at, count, file = at + here, count - here, file + 1
            return b"".join(parts)

        for batch in batches:
            for shard in batch["id"]:
                slots = np.arange(shard * per_shard, min(n, (shard + 1) * per_shard))
                sequence = permute(slots, n, key, back=True)
                records: list[bytes] = [b""] * len(slots)
                for i in np.argsort(sequence):
                    at = int(sequence[i]) * window
                    records[i] = tokens(at, min(window, total - at))
                sizes = [len(r) // width for r in records]
                pad = np.array([PAD], dtype=f"<u{width}").tobytes()
                records = [r + pad * (window - m) for r, m in zip(records, sizes)]
                name = f"{folder}/_writing-{shard:08d}-{uuid.uuid4().hex}"
                with create(name) as out:
                    for r in records:
                        out.write(r)
                # A second attempt writes the same bytes; the last rename stands.
                rename(name, f"{folder}/shard-{shard:08d}.bin")
                yield pd.DataFrame(
                    {
                        "sequence_id": sequence,
                        "slot": slots,
                        "shard": shard,
                        "byte_offset": (slots % per_shard) * stride,
                        "n_tokens": sizes,
                        "record_crc32": [zlib.crc32(r) for r in records],
                    }
                )

    return run


def materialise(
    listing: DataFrame, folder: str, key: int, window: int = WINDOW, per_shard: int = PER_SHARD, width: int = 2
) -> DataFrame:
    """Write the shards of all listed streams to ``folder``; the index of all sequences.

    Each record is ``window`` ids of ``width`` bytes, little-endian; only the last
    sequence can be short, and is padded with 0. No tokens, no shards. The index
    is landed: it is there after the shards are.
    """
    spark: SparkSession = listing.sparkSession
    # One row per encoding task, which is what the scheduler itself holds.
    files = listing.where("tokens > 0").orderBy("part").collect()
    starts = [0]
    for f in files:
        starts.append(starts[-1] + f["tokens"])
    total = starts.pop()
    shards = -(-total // (window * per_shard))
    sent = spark.sparkContext.broadcast(([f["path"] for f in files], starts, total))
    numbers = spark.range(0, shards, 1, max(1, min(shards, 100_000)))
    return land(numbers.mapInPandas(_shards(sent, folder, key, window, per_shard, width), SCHEMA), "training-order-index")


def read_back(index: DataFrame, folder: str, window: int = WINDOW, width: int = 2) -> DataFrame:
    """The index with ``ids_crc32``: the checksum of each record's ids (unsigned 32-bit, without padding) as read from its shard."""
    stride = window * width

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums = []
            for shard, at, n in zip(batch["shard"], batch["byte_offset"], batch["n_tokens"]):
                raw = read_range(f"{folder}/shard-{shard:08d}.bin", at, stride)
                sums.append(zlib.crc32(np.frombuffer(raw, dtype=f"<u{width}")[:n].astype("<u4").tobytes()))
            yield batch.assign(ids_crc32=sums)

    return index.mapInPandas(run, f"{SCHEMA}, ids_crc32 bigint")
