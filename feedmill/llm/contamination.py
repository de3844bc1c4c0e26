"""Benchmark passages in documents, found by spaced seeds.

A seed looks at a fixed pattern of places in a window of words and passes over
the others, so a word that was changed there does not hide the match. The seeds
of all benchmark items are an index; the seeds of every window of every document
are looked up in it. Each hit lines an item up with a place in the document; the
words around it are then compared one by one, and the best stretch that allows
for some changed words is the verified overlap.

The index of a benchmark is sent to the executors in blocks of bounded size; a
benchmark of several blocks is matched block by block, against all documents.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import land

#: Items of fewer words than ``LEAST_EQUAL`` are matched whole; below this many words, never.
SHORTEST_ITEM = 5
#: Words that must agree in a verified overlap (or the whole item, if that is shorter).
LEAST_EQUAL = 10
#: What a changed word costs against an equal one: an overlap has at least three quarters equal words.
CHANGE_COST = 3
#: Places looked at (1) and passed over (0). Every verified overlap of LEAST_EQUAL words ends in a window of
#: one of these: all its tails are worth more than nothing, so it ends in 7 or more equal words, or in 6, 5 or
#: 4 that follow a single change, with at least 1, 2 or 3 equal words before that.
MASKS = ("1111111", "10111111", "11011111", "11101111")
#: Words of benchmark items in one block of the index: some 32 bytes each and mask.
BLOCK_WORDS = 500_000
FILTER_BITS = 22
KNOWN_WORDS = 150_000

_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
_ODD = np.random.default_rng(20240229).integers(2**62, 2**63, LEAST_EQUAL, dtype=np.uint64) | np.uint64(1)

SPANS = "array<struct<item_id:bigint,first_word:bigint,n_words:bigint,n_equal:bigint>>"


class _Hashes(dict):
    """Word to 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_known = _Hashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Letters, digits and anything beyond ASCII make words; capitals of ASCII count as small letters."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()
    return np.fromiter(map(_known.__getitem__, words), dtype=np.uint64, count=len(words))


def seeds(hashes: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """One number for each window of the mask's length."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, salt + 1, dtype=np.uint64)
    for k, used in enumerate(mask):
        if used == "1":
            out += hashes[k : k + n] * _ODD[k]
    out ^= out >> np.uint64(32)
    return out * _ODD[0]


class Index:
    """Seeds of one block of items, sorted, with the item and place of each."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = [i for i, _ in items]
        self.words = [word_hashes(text) for _, text in items]
        short = sorted({len(w) for w in self.words if SHORTEST_ITEM <= len(w) < LEAST_EQUAL})
        self.masks = [*MASKS, *("1" * n for n in short)]
        found, owners, places = [], [], []
        for number, words in enumerate(self.words):
            for salt, mask in enumerate(self.masks):
                whole = salt >= len(MASKS)
                if whole == (len(words) < LEAST_EQUAL) and (not whole or len(mask) == len(words)):
                    found.append(made := seeds(words, mask, salt))
                    owners.append(np.full(len(made), number, dtype=np.int64))
                    places.append(np.arange(len(made), dtype=np.int64))
        none = [np.empty(0, dtype=np.uint64)]
        seed, owner, place = (np.concatenate(x or none) for x in (found, owners, places))
        order = np.argsort(seed, kind="stable")
        self.seed, self.owner, self.place = seed[order], owner[order], place[order]
        self.quick = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.quick[self.seed >> np.uint64(64 - FILTER_BITS)] = True

    def candidates(self, hashes: np.ndarray) -> set[tuple[int, int]]:
        """(item, diagonal) of every hit."""
        out: set[tuple[int, int]] = set()
        for salt, mask in enumerate(self.masks):
            made = seeds(hashes, mask, salt)
            at = np.flatnonzero(self.quick[made >> np.uint64(64 - FILTER_BITS)])
            if not len(at):
                continue
            lo = np.searchsorted(self.seed, made[at], "left")
            hi = np.searchsorted(self.seed, made[at], "right")
            for pos, a, b in zip(at[hi > lo], lo[hi > lo], hi[hi > lo]):
                out.update((int(self.owner[k]), int(pos - self.place[k])) for k in range(a, b))
        return out


def overlap(words: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """The best stretch where the item lies at ``diagonal``: first word, words, equal words."""
    lo, hi = max(0, diagonal), min(len(words), diagonal + len(item))
    equal = words[lo:hi] == item[lo - diagonal : hi - diagonal]
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -CHANGE_COST))])
    gain = score - np.minimum.accumulate(score)
    end = int(gain.argmax())
    start = int(score[: end + 1].argmin())
    return lo + start, end - start, int(equal[start:end].sum())


def passages(text: str | None, index: Index) -> list[tuple[int, int, int, int]]:
    """Verified overlaps of a text: item id, first word, words, equal words; in order."""
    words = word_hashes(text)
    if len(words) < SHORTEST_ITEM:
        return []
    out = set()
    for number, diagonal in index.candidates(words):
        item = index.words[number]
        first, n, equal = overlap(words, item, diagonal)
        if equal >= min(LEAST_EQUAL, len(item)):
            out.add((index.ids[number], first, n, equal))
    return sorted(out)


@functools.lru_cache(maxsize=1)
def _index(items: tuple[tuple[int, str], ...]) -> Index:
    return Index(list(items))


def _finder(docs: DataFrame, items: list[tuple[int, str]]):
    sent = docs.sparkSession.sparkContext.broadcast(tuple(items))

    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = _index(sent.value)
        names = ("item_id", "first_word", "n_words", "n_equal")
        for texts in batches:
            yield pd.Series([[dict(zip(names, row)) for row in passages(t, index)] for t in texts], dtype=object)

    return find


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of some ``block_words`` words; items without id or text are passed over."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").dropna().distinct()
    words = F.size(F.split("text", r"\s+"))
    total = items.agg(F.coalesce(F.sum(words), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [(r["item_id"], r["text"]) for r in items.where(block == k).orderBy("item_id", "text").collect()]


def scan(docs: DataFrame, items: list[tuple[int, str]], text: str = "text") -> DataFrame:
    """Every row, as struct ``row``, with its ``spans`` for one block of items."""
    row: Column = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), _finder(docs, items)(F.col(f"`{text}`")).alias("spans"))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, first_word, n_words, n_equal``: one row per verified overlap.

    Null and empty texts have none. Rows that repeat are each reported; a row
    without an id is reported with a null. An empty benchmark finds nothing.
    Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
    """
    rows = docs.select("doc_id", "text")
    found = [
        scan(rows, items).select(F.col("row.doc_id").alias("doc_id"), F.explode("spans").alias("s"))
        for items in blocks(benchmark)
    ]
    every = functools.reduce(DataFrame.unionByName, found)
    return every.select("doc_id", "s.item_id", "s.first_word", "s.n_words", "s.n_equal")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The input rows without any verified overlap, with the input's columns."""
    out = docs
    for k, items in enumerate(blocks(benchmark)):
        if k:
            out = land(out, "decontaminated")  # one block's index in memory at a time
        out = scan(out, items).where(F.size("spans") == 0).select("row.*")
    return out
