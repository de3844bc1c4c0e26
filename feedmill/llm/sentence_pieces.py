"""SentencePiece encoding that knows where each piece came from.

A text is normalised first. The model's compiled character map is a double-array
trie over bytes; at every place the longest key that the text goes on with is
replaced, and each byte put out notes the byte of the source it stands for. White
space becomes the model's mark. The normalised text is cut where no piece can
reach across, and each distinct cut is merged once a worker, best score first.
Piece lengths added up are borders in the normalised text; the noted alignment
turns them into byte spans of the source.

Texts of a task are worked on some rows at a time: the ids of their cuts are
gathered by number, without a step per piece in Python.
"""

from __future__ import annotations

import functools
import heapq
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.llm.ragged import Made, Memory
from feedmill.llm.token_counts import ship

SPACE = "▁"
#: Field numbers of the model file, and its kinds of pieces.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
#: Cuts that a worker remembers.
KNOWN_CUTS = 150_000
ROWS_AT_ONCE = 200
#: The id that ends a text.
END = 2
#: Longer cuts are merged by a heap.
SHORT_CUT = 64
NONE = np.iinfo(np.int64).max


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a message of the model file."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = number() if key & 7 == 2 else 4 if key & 7 == 5 else 8
        yield key >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """The compiled map: a size, a double-array trie of that many bytes, and the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self._units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self._texts = blob[4 + size :]

    def __bool__(self) -> bool:
        return bool(self._units)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """How many bytes from ``at`` on the longest key has, 0 for none, and what replaces it."""
        units, node, found = self._units, 0, (0, -1)
        node ^= _offset(units[0])
        for n, byte in enumerate(data[at : at + 256], 1):
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found = (n, units[node] & 0x7FFFFFFF)
        size, place = found
        return size, self._texts[place : self._texts.index(b"\0", place)] if size else b""


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 512) >> 6)


class Normalizer:
    """Fields of the model's normalizer: the map, a space before the text, no extra spaces, spaces as marks."""

    def __init__(self, spec: bytes) -> None:
        found = dict(_fields(spec))
        self.map = CharacterMap(found.get(2, b""))
        self.prefix, self.trim, self.marks = (bool(found.get(k, 1)) for k in (3, 4, 5))

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the byte of the source it stands for."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, dtype=np.int32)
        if self.map or self.trim or not self.marks:
            return self._mapped(data)
        lead = len(SPACE.encode()) if self.prefix else 0
        width = np.where(np.frombuffer(data, dtype=np.uint8) == 32, 3, 1)
        source = np.zeros(lead + int(width.sum()) + 1, dtype=np.int32)
        source[lead:-1] = np.repeat(np.arange(len(data), dtype=np.int32), width)
        source[-1] = len(data)
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE), source

    def _mapped(self, data: bytes) -> tuple[str, np.ndarray]:
        space = SPACE.encode() if self.marks else b" "
        out, source, at, blank = bytearray(), [], 0, self.trim

        def put(part: bytes, place: int) -> None:
            out.extend(part)
            source.extend([place] * len(part))

        pieces = []  # (source byte, replacement) of the text, the spaces before it left out if need be
        while at < len(data):
            size, part = self.map.longest(data, at) if self.map else (0, b"")
            if not size:
                size = 1 if data[at] < 0xC0 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                part = data[at : at + size]
            pieces.append((at, part))
            at += size
        first = 0
        while self.trim and first < len(pieces) and pieces[first][1] == b" ":
            first += 1
        if first == len(pieces):
            return "", np.array([len(data)], dtype=np.int32)
        if self.prefix:
            put(space, pieces[first][0])
        for place, part in pieces[first:]:
            if blank:
                part = part.lstrip(b" ")
            if part:
                for byte in part:
                    put(space if byte == 32 else bytes([byte]), place)
                blank = self.trim and part.endswith(b" ")
        end = len(data)
        while self.trim and out.endswith(space):
            del out[-len(space) :]
            end = source[len(out)]
            del source[len(out) :]
        return out.decode(), np.array([*source, end], dtype=np.int32)


class Model:
    """Pieces of a byte-pair model with a byte for every character it does not know."""

    def __init__(self, data: bytes) -> None:
        pieces, trainer, spec = [], {}, b""
        for field, value in _fields(data):
            if field == PIECE:
                pieces.append(dict(_fields(value)))
            elif field == TRAINER:
                trainer = dict(_fields(value))
            elif field == NORMALIZER:
                spec = value
        kinds = [p.get(3, NORMAL) for p in pieces]
        if trainer.get(3) != BPE or trainer.get(24) or kinds.count(BYTE) != 256 or {USER_DEFINED, UNUSED} & set(kinds):
            raise ValueError("not a byte-pair model with byte pieces and normal ones alone")
        self.normalize = Normalizer(spec)
        self.size = np.array([1 if k == BYTE else len(p[1]) for p, k in zip(pieces, kinds)], dtype=np.int32)
        self._bytes = [i for i, k in enumerate(kinds) if k == BYTE]
        self._ids = {p[1].decode(): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == NORMAL}
        score = {i: struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0] for i, p in enumerate(pieces)}
        self._id_of = np.full(0x110000, -1, dtype=np.int64)  # by code point
        for piece, number in self._ids.items():
            if len(piece) == 1:
                self._id_of[ord(piece)] = number
        # Merges by rank, best first; equal scores are one rank, so that the place decides.
        ranks = {s: r for r, s in enumerate(sorted({score[i] for i in self._ids.values()}, reverse=True))}
        self._rank = {p: ranks[score[i]] for p, i in self._ids.items() if len(p) > 1}
        merges = sorted(
            (self._ids[p[:k]] * len(pieces) + self._ids[p[k:]], self._rank[p], self._ids[p])
            for p in self._rank
            for k in range(1, len(p))
            if p[:k] in self._ids and p[k:] in self._ids
        )
        self._n, self._pairs = len(pieces), np.array(merges, dtype=np.int64).reshape(-1, 3).T.copy()
        # Where no piece has a mark behind another character, and a line end in it, texts can be cut there.
        if any(SPACE in p.lstrip(SPACE) for p in self._rank):
            self._cut = re.compile(r".+", re.S)
        elif any("\n" in p for p in self._rank):
            self._cut = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        else:
            self._cut = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")
        self._memory = Memory(KNOWN_CUTS, self._make)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, ``NONE`` where it is no piece."""
        keys = left * self._n + right
        at = np.minimum(np.searchsorted(self._pairs[0], keys), len(self._pairs[0]) - 1)
        return np.where((self._pairs[0][at] == keys) & (left >= 0) & (right >= 0), self._pairs[1][at], NONE)

    def _merge(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all cuts in one row, and how many each has.

        In every round each cut joins one pair, that with the best score, the left
        one of equals; cuts without a pair that is a piece are finished.
        """
        if not cuts:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        points = np.frombuffer("".join(cuts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        size = np.array([len(c) for c in cuts])
        # Unknown characters are below zero.
        ids, owner = self._id_of[points], np.repeat(np.arange(len(cuts)), size)
        ids = np.where(ids < 0, -1 - points, ids)
        rank = np.full(len(ids), NONE)
        rank[:-1] = np.where(owner[1:] == owner[:-1], self._ranks(ids[:-1], ids[1:]), NONE)
        done_ids, done_owner = [], []
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(ids)))
            over = np.repeat(best == NONE, length)
            done_ids.append(ids[over])
            done_owner.append(owner[over])
            at = np.flatnonzero((rank == np.repeat(best, length)) & ~over)
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])] if len(at) else at
            pair = np.searchsorted(self._pairs[0], ids[at] * self._n + ids[np.minimum(at + 1, len(ids) - 1)])
            ids[at] = self._pairs[2][pair]
            stays = ~over
            stays[at + 1] = False
            moved = (np.cumsum(stays) - 1)[at]
            ids, owner, rank = ids[stays], owner[stays], rank[stays]
            for left in (moved - 1, moved):
                left = left[(left >= 0) & (left + 1 < len(ids))]
                same = owner[left] == owner[left + 1]
                rank[left] = np.where(same, self._ranks(ids[left], ids[left + 1]), NONE)
            rank[moved[moved == len(ids) - 1]] = NONE
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        ids, owner = ids[order], owner[order]
        if ids.min(initial=0) < 0:
            spelt = [[i] if i >= 0 else [self._bytes[b] for b in chr(-1 - i).encode()] for i in ids.tolist()]
            owner = np.repeat(owner, [len(s) for s in spelt])
            ids = np.array([i for s in spelt for i in s])
        return ids.astype(np.uint32), np.bincount(owner, minlength=len(cuts))

    def _long(self, cut: str) -> list[int]:
        """Ids of a long cut, by a heap of its pairs."""
        parts = list(cut)
        ranks, n = self._rank, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def look(i: int) -> None:
            if i >= 0 and after[i] < n:
                pair = parts[i] + parts[after[i]]
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], i, pair))

        for i in range(n - 1):
            look(i)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= n or parts[i] + parts[j] != pair:
                continue  # one of the two was joined with another meanwhile
            parts[i], parts[j] = pair, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            look(before[i])
            look(i)
        out = []
        for part in filter(None, parts):
            number = self._ids.get(part)
            out.extend([number] if number is not None else [self._bytes[b] for b in part.encode()])
        return out

    def _make(self, cuts: list[str]) -> Made:
        long = np.array([len(c) > SHORT_CUT for c in cuts])
        order = np.concatenate([np.flatnonzero(~long), np.flatnonzero(long)])
        ids, count = self._merge([cuts[k] for k in np.flatnonzero(~long)])
        for k in np.flatnonzero(long):
            made = self._long(cuts[k])
            ids, count = np.append(ids, np.array(made, dtype=np.uint32)), np.append(count, len(made))
        return order, ids, count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``offsets`` of the texts in ``ids``, ``starts`` and ``ends``: each piece and its byte span in its text."""
        normal = [self.normalize(t) for t in texts]
        cuts, per_text = [], []
        for text, _ in normal:
            found = self._cut.findall(text)
            cuts += found
            per_text.append(len(found))
        coded = pa.array(cuts, pa.string()).dictionary_encode()
        which = coded.indices.to_numpy()
        distinct = coded.dictionary.to_pylist()
        numbers = self._memory.numbers(distinct, np.bincount(which, minlength=len(distinct)))
        ids, count = self._memory.gather(numbers[which])
        total = len(ids)
        borders = np.concatenate([[0], np.cumsum(count)])
        offsets = borders[np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)]
        # Borders of pieces in each normalised text, and from there to the source.
        size = np.concatenate([[0], np.cumsum(self.size[ids], dtype=np.int64)])
        starts, stops = np.empty(total, dtype=np.int32), np.empty(total, dtype=np.int32)
        for (_, source), lo, hi in zip(normal, offsets[:-1], offsets[1:]):
            at = source[size[lo : hi + 1] - size[lo]]
            starts[lo:hi], stops[lo:hi] = at[:-1], at[1:]
        return offsets, ids, starts, stops


@functools.lru_cache(maxsize=1)
def _model(path: str) -> Model:
    with open(path, "rb") as file:
        return Model(file.read())


def _encode(name: str, keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(SparkFiles.get(name))
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(lo, ROWS_AT_ONCE)
                offsets, *found = model.encode(rows.column("text").to_pylist())
                lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32())) for x in found]
                columns = [rows.column(k) for k in keys]
                yield pa.RecordBatch.from_arrays([*columns, *lists], [*keys, "ids", "starts", "ends"])

    return run


def encode(docs: DataFrame, model: str, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keys`` of every row with ``ids``, ``starts`` and ``ends``: pieces and their byte spans in the text's UTF-8.

    Spans follow one another without gaps; a piece that the normalizer put in has
    an empty one, and pieces made from one replaced key share its first byte. A
    null or empty text has no pieces, rows that repeat are encoded each, an empty
    table gives none, and columns other than keys and text are not read.
    """
    name = ship(docs.sparkSession, model)
    rows = docs.select(*[F.col(f"`{k}`") for k in keys], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    lists = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("ids", "starts", "ends")]
    schema = T.StructType([*rows.schema.fields[:-1], *lists])
    return rows.mapInArrow(_encode(name, list(keys)), schema)


def decode(spark, ids: Column, model: str) -> Column:
    """The text of each list of ids, by the library."""
    name = ship(spark, model)

    @F.pandas_udf(T.StringType())
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=SparkFiles.get(name))
        for lists in batches:
            yield pd.Series([pieces.decode(x.tolist()) if len(x) else "" for x in lists], dtype=object)

    return texts(ids)
