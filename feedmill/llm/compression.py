"""Quality by compression: which of two dictionaries makes a text smaller.

A zstandard dictionary is built from good labelled texts and one from bad ones.
A text is cut into blocks, every block is compressed with either dictionary, and
the sums give one number: ``(bad - good) / (bad + good)``, above zero if the good
dictionary does better. Small blocks keep the dictionary in play: in one long
stream the text's own past would soon replace it. Texts and dictionaries are
reduced to their shape first (small letter, capital, digit, or the mark itself),
because a dictionary of words says which words, not how well they are written.
Two pairs of dictionaries differ in size and block; a logistic curve over their
two numbers, fitted on labelled texts that built no dictionary, gives a
probability.

Labels only choose the training rows; nothing but the text is scored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import land

#: At most this many labelled rows of each class are fitted on, the least by a hash of the id.
ROWS_PER_CLASS = 1200
#: Bytes of a dictionary and of a text's block, for each pair.
PAIRS = ((32 * 1024, 128), (16 * 1024, 192))
LEVEL = 3
THRESHOLD = 0.7
HELD_OUT = 2
#: A row longer than this many bytes is not fitted on (it is scored like any other).
LONGEST_FITTED = 64 * 1024
#: Bytes that a text gives to a dictionary, at least.
LEAST_SHARE = 48
#: The belief without labels, in standard deviations of a pair's number and in log odds: a text that
#: the good dictionary makes smaller is a little likelier good, and nearly all are good. It weighs as
#: much as so many rows.
START_SLOPE, START_OFFSET, START_ROWS = 0.1, 3.5, 2.0
START_SCALE = 0.05


#: Bytes to their shape: a small letter (or any byte beyond ASCII), a capital, a digit, or as they are.
SHAPE = bytes(
    97 if 97 <= b <= 122 or b > 127 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)
)


@dataclass(frozen=True)
class Model:
    """``pairs``: (good, bad) dictionary contents; ``slopes``: one for each pair."""

    pairs: tuple[tuple[bytes, bytes], ...]
    slopes: tuple[float, ...]
    offset: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def shape(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(SHAPE)


@functools.lru_cache(maxsize=16)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)


def differences(text: str | None, pairs: tuple[tuple[bytes, bytes], ...]) -> list[float]:
    """The normalised size difference under each pair; 0 for a null or empty text."""
    data = shape(text)
    out = []
    for (good, bad), (_, block) in zip(pairs, PAIRS):
        with_good, with_bad = _compressor(good).compress, _compressor(bad).compress
        n_good = n_bad = 0
        for at in range(0, len(data), block):
            part = data[at : at + block]
            n_good += len(with_good(part))
            n_bad += len(with_bad(part))
        out.append((n_bad - n_good) / (n_bad + n_good) if data else 0.0)
    return out


def probability(x: np.ndarray, slopes: tuple[float, ...], offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ np.array(slopes) + offset, -50, 50)))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Slopes and offset by Newton's method, drawn to the starting belief; with few rows they stay near it."""
    scale = x.std(axis=0) if len(x) else np.zeros(x.shape[1])
    scale[scale == 0] = START_SCALE
    z = np.column_stack([x / scale, np.ones(len(x))])
    start = np.array([START_SLOPE] * x.shape[1] + [START_OFFSET])
    w = start.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -50, 50)))
        grad = z.T @ (p - y) + START_ROWS * (w - start)
        hess = (z * (p * (1 - p))[:, None]).T @ z + START_ROWS * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        step /= max(1.0, np.abs(step).max())  # far from the answer a whole step can lead astray
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1] / scale, float(w[-1])


def dictionary(texts: list[str], size: int) -> bytes:
    """Raw dictionary content: an even share from the middle of every text.

    Where that would be less than ``LEAST_SHARE`` bytes, texts at even steps give so much.
    """
    most = size // (LEAST_SHARE + 1)
    texts = [texts[len(texts) * k // most] for k in range(most)] if len(texts) > most else texts
    if not texts:
        return b" "
    share = size // len(texts) - 1
    parts = []
    for text in texts:
        data = shape(text)
        start = max(0, (len(data) - share) // 2)
        parts.append(data[start : start + share])
    return b"\n".join(parts) or b" "


def train(rows: list[tuple[str, int]], weights: tuple[float, float]) -> Model:
    """A model from (text, label) rows; ``weights``: how many corpus rows stand for a bad and a good one.

    Every other row of a class builds its dictionaries, the rest fit the curve.
    The fewer rows there are, the nearer it stays to the starting belief, under
    which scores differ a little and no text is rejected.
    """
    of = {c: [text for text, y in rows if y == c] for c in (0, 1)}
    pairs = tuple((dictionary(of[1][::2], size), dictionary(of[0][::2], size)) for size, _ in PAIRS)
    rest = [(text, c) for c in (0, 1) for text in of[c][1::2]]
    x = np.array([differences(text, pairs) for text, _ in rest]).reshape(-1, len(PAIRS))
    slopes, offset = logistic(x, np.array([c for _, c in rest], dtype=float))
    # The sample is even-handed between the classes; the corpus is not. Half of it was fitted on.
    bad, good = (np.log((weights[c] / 2 + 1) / (len(of[c]) // 2 + 1)) for c in (0, 1))
    return Model(pairs, tuple(float(s) for s in slopes), float(offset + good - bad))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows of ``docs`` outside the held-out fold.

    Rows without a label or id, and ids whose labels disagree, are not fitted
    on. Equal rows of an id count once. Only labels of ids in ``docs`` are counted
    and chosen from, so sample and counts both describe the rows to be scored.
    """
    marks = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("y2")).where("y = y2").drop("y2")
    fits = F.coalesce(F.octet_length("text").between(1, LONGEST_FITTED), F.lit(False))
    there = docs.groupBy("doc_id").agg(F.max(fits).alias("fits"))
    marks = land(marks.join(there, "doc_id"), "classifier-labels")
    totals = {r["y"]: r["count"] for r in marks.groupBy("y").count().collect()}
    order = F.xxhash64("doc_id", F.lit("fit"))
    fold = [marks.where(F.col("fits") & (F.col("y") == y)).orderBy(order, "doc_id").limit(ROWS_PER_CLASS) for y in (0, 1)]
    chosen = F.broadcast(fold[0].unionByName(fold[1]).drop("fits"))  # at most two times ROWS_PER_CLASS ids
    texts = docs.select("doc_id", "text").where(fits)
    # Copies of an id are met here by partial aggregation.
    rows = texts.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).orderBy("doc_id").collect()
    return train([(r["text"], r["y"]) for r in rows], (totals.get(0, 0), totals.get(1, 0)))


def scorer(docs: DataFrame, model: Model):
    """A column function from text to score, with the model sent to the executors once."""
    sent = docs.sparkSession.sparkContext.broadcast((model.pairs, model.slopes, model.offset))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pairs, slopes, offset = sent.value
        for texts in batches:
            x = np.array([differences(t, pairs) for t in texts]).reshape(-1, len(pairs))
            yield pd.Series(probability(x, slopes, offset))

    return score


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row, as struct ``row``, with its ``score`` (0 to 1) and ``predicted`` (0 or 1).

    Null and empty texts get the curve's value at 0. Equal texts get equal
    scores, an empty table an empty result, and other columns stay in ``row``.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scored = docs.select(row.alias("row"), scorer(docs, model)(F.col(f"`{text}`")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
