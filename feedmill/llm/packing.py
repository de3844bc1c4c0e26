"""Concatenate and cut: all documents, end to end, in windows of one size.

First pass: every task encodes its documents and notes where each starts among
the tokens of its partition; the partitions' totals are added up to the offset
of each partition in the whole stream. Second pass: a document's place in the
stream says which windows it falls in; it is cut at their borders, and each
piece is a boundary record (document, start, length, sequence, offset). Every
sequence but the last is full, so there is no padding to speak of.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Callable, Iterator
from itertools import batched, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm.common import land, small_batches
from feedmill.llm.ragged import Made, Memory, gather
from feedmill.llm.token_counts import ship

WINDOW = 4096
END = 2
#: Words that a worker remembers the ids of: about 200 bytes each, beside the memory of the JVM.
CACHE_WORDS = 300_000
#: Words that the library gets as one text.
WORDS_AT_ONCE = 1000
WORD_END = "</w>"
#: Words of letters that the tokenizer keeps together and lowers one by one.
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
#: Where marks begin that are a token run of their own: behind such a letter.
LETTER_LAST = "[A-Za-zÀ-ÖØ-öø-ÿ]$"
#: Marks of ASCII but for the apostrophe, which the tokenizer takes together with letters behind it.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: How strings begin that the tokenizer takes as one token wherever they stand.
SPECIAL = "<|"
TOKEN_BYTES = 4

_STREAM = "doc_id bigint, doc_tokens bigint, ids binary, part int, at bigint"
_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)
_PIECE_NAMES = [column.split()[0] for column in _PIECES.split(", ")]
#: Rows a task works on at a time: their words take many times the memory of their texts.
ROWS_AT_ONCE = 250


class WordEncoder:
    """Ids of texts through the library, word by word.

    The tokenizer splits at white space before anything else and drops it, so the
    ids of a text are those of its words in order; it also splits between a letter
    and the marks that end a word. Arrow cuts a batch into words, numbers the
    distinct ones and parts these from their marks; the library sees each part
    once per worker, for as long as the worker remembers it.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        vocabulary = self._tokenizer.get_vocab()
        # Ids that end a run of letters, if the vocabulary marks them.
        self._ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self._ends[[i for piece, i in vocabulary.items() if piece.endswith(WORD_END)]] = True
        self._memory = Memory(CACHE_WORDS, self._make)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [f.ids for f in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        count = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=count.sum()), count

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of plain letters, many in one text: each ends where an id that ends a word stands."""
        made = []
        for some in batched(words, WORDS_AT_ONCE):
            (found,) = self._tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, dtype=np.uint32)
            ends = np.flatnonzero(self._ends[ids]) + 1
            told = len(ends) == len(some) and ends[-1] == len(ids)
            made.append((ids, np.diff(ends, prepend=0)) if told else self._each(list(some)))
        return tuple(np.concatenate(x) for x in zip(*made))

    def _make(self, words: list[str]) -> Made:
        plain = pc.match_substring_regex(pa.array(words, pa.string()), PLAIN).to_numpy(zero_copy_only=False)
        letters, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        made = [self._each([words[k] for k in rest])]
        if len(letters):
            made.insert(0, self._joined([words[k] for k in letters]))
        return np.concatenate([letters, rest]), *(np.concatenate(x) for x in zip(*made))

    def _parted(self, words: pa.LargeStringArray) -> pa.LargeStringArray:
        """Each word in two parts, one behind the other: up to its last letter and the marks behind that, which may be none."""
        stems = pc.utf8_rtrim(words, MARKS)
        cut = pc.and_not(pc.match_substring_regex(stems, LETTER_LAST), pc.match_substring(words, SPECIAL))
        borders = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset :][: len(words) + 1]
        ends = borders[:-1] + pc.binary_length(pc.if_else(cut, stems, words)).to_numpy()
        offsets = np.append(np.column_stack([borders[:-1], ends]).ravel(), borders[-1])
        return pa.LargeStringArray.from_buffers(2 * len(words), pa.py_buffer(offsets), words.buffers()[2])

    def _distinct(self, words: pa.LargeStringArray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words that occur so many ``times``, and how many each has."""
        parts = self._parted(words).dictionary_encode()
        which, spelt = parts.indices.to_numpy(), parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        uses = np.bincount(which, np.repeat(times, 2), minlength=len(spelt)).astype(np.int64)
        ids, count = self._memory.gather(self._memory.numbers(spelt, uses)[which])
        return ids, count[0::2] + count[1::2]

    def encode_rows(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the texts in the row of all their ids, each text's ``end`` behind it if there is one."""
        made = self._rows(texts, end)
        # Arrow keeps what it has freed; the other processes of the executor need it more.
        pa.default_memory_pool().release_unused()
        return made

    def _rows(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.replace_substring(texts.cast(pa.large_string()), "\n", " ")
        words = (lists := pc.split_pattern(texts, " ")).flatten()
        # Words of ASCII are lowered by the tokenizer anyway; not so special strings (<|...|>), which it
        # takes in small letters only. Beyond ASCII that is left to it.
        lowered = pc.and_not(pc.string_is_ascii(words), pc.match_substring(words, SPECIAL))
        words = pc.if_else(lowered, pc.ascii_lower(words), words)
        coded = words.dictionary_encode()
        which = coded.indices.to_numpy()
        ids, count = self._distinct(coded.dictionary, np.bincount(which, minlength=len(coded.dictionary)))
        start, count = (np.cumsum(count) - count)[which], count[which]
        ids = gather(ids, start, count)
        borders = np.concatenate([[0], np.cumsum(count)])
        offsets = borders[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        if end is not None:
            ids = np.insert(ids, offsets[1:], end)
            offsets = offsets + np.arange(len(offsets))
        return offsets, ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as unsigned 32-bit little-endian bytes."""
        offsets, ids = self.encode_rows(pa.array(texts, pa.string()))
        return [ids[lo:hi].astype("<u4").tobytes() for lo, hi in zip(offsets, offsets[1:])]


@functools.lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _encode(name: str, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = word_encoder(SparkFiles.get(name)), TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(lo, ROWS_AT_ONCE)
                offsets, ids = encoder.encode_rows(rows.column("text"), end)
                data = [None, pa.py_buffer((offsets * TOKEN_BYTES).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.Array.from_buffers(pa.binary(), rows.num_rows, data),
                        pa.array([part] * rows.num_rows, pa.int32()),
                        pa.array(at + offsets[:-1], pa.int64()),
                    ],
                    ["doc_id", "doc_tokens", "ids", "part", "at"],
                )
                at += len(ids)

    return run


def _cut(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(lo, ROWS_AT_ONCE)
                out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
                values = zip(*(rows.column(c).to_pylist() for c in ("doc_tokens", "ids", "place")))
                for row, (n, ids, place) in enumerate(values):
                    start = 0
                    while start < n:
                        sequence, offset = divmod(place + start, window)
                        length = min(n - start, window - offset)
                        piece = ids[start * TOKEN_BYTES : (start + length) * TOKEN_BYTES]
                        for to, value in zip(out, (row, start, length, zlib.crc32(piece), n, sequence, offset, piece)):
                            to.append(value)
                        start += length
                numbers = [pa.array(x, pa.int64()) for x in out[1:7]]
                doc = rows.column("doc_id").take(pa.array(out[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([doc, *numbers, pa.array(out[7], pa.binary())], _PIECE_NAMES)

    return run


def stream(docs: DataFrame, tokenizer: str, text: str = "text", end: int = END) -> DataFrame:
    """All documents with their ids and ``place``, the number of ids before them in the whole stream.

    The order is that of the partitions and of the rows in them, as the first
    pass wrote it; landing that pass fixes it.
    """
    small_batches(docs.sparkSession)
    name = ship(docs.sparkSession, tokenizer)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    encoded = land(rows.mapInArrow(_encode(name, end), _STREAM), "packing-ids")
    totals = encoded.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # One row per task of the first pass, which is what the scheduler itself holds.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return encoded.join(F.broadcast(bases), "part").withColumn("place", F.col("base") + F.col("at")).drop("part", "at", "base")


def cut(streamed: DataFrame, window: int = WINDOW) -> DataFrame:
    return streamed.mapInArrow(_cut(window), _PIECES)


def pack(docs: DataFrame, tokenizer: str, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    A null or empty text is the end token alone. Null ids stay null, rows that
    repeat are packed each, an empty table gives no pieces, and columns other
    than the id and text are not read.
    """
    return cut(stream(docs, tokenizer, text), window)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the pieces of a sequence, at most a window of tokens, put together."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id",
        "n_tokens",
        F.aggregate(F.col("parts.ids"), F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
    )
