"""Which filter removes what in which order: all orders of the filters at once.

A document fails some of ``k`` filters: its mask. Under an order it goes at the
first of its filters. The orders that begin with the same letters lie side by
side in the lexicographic list of all ``k!`` permutations, and their Lehmer rank
says where; so the orders in which a mask goes at one step, by one filter, are a
few intervals of ranks. Per step, the counts of every mask are added at the
beginning of its intervals and taken off at their end; a prefix sum over the
ranks gives the removals under each order, without any order being applied.

Documents meet as a histogram of masks, at most ``2 ** k`` rows a part, by partial
aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.llm.common import land

LETTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
MARKS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

AUDIT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def _mask(text: str) -> int:
    """Bits 0 to 3: the text fails A, B, C, D."""
    data = text.encode()
    words = data.split()  # at blanks and the control characters 9 to 13
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > MAX_CAPITAL_PERCENT * len(text)) << 2
        | (len(data.translate(None, MARKS)) < len(data)) << 3
    )


@F.pandas_udf(T.IntegerType())
def _masks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([_mask(t) for t in texts], dtype="int32")


def histogram(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, and those labelled good and toxic, of each mask of five filters.

    The part is the source. A null source is the empty one, a null text the empty
    text. A row without an id never fails E and makes no other row fail it; rows
    that share the least id of a text all pass E. An id with several labels counts
    as good, or toxic, if one of them says so. Only ``doc_id``, ``text`` and
    ``source`` are read.

    Texts are compared by SHA-256 and never shuffled. A text or id that many rows
    share is summed before each shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        _masks(text).alias("mask"),
    )
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    marks = marks.agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])
    rows = rows.join(marks, "doc_id", "left").na.fill(False, ["good", "toxic"])

    # All rows of a digest have one mask. Within a group ids differ, so the least row has all rows of the least id.
    some = F.col("doc_id").isNotNull().alias("some")
    groups = rows.groupBy("digest", "mask", "part", "good", "toxic", some).agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("least")
    )
    groups = land(groups, "audit-groups")
    owned = groups.where("some").withColumn("doc_id", F.col("least.doc_id"))
    firsts = owned.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    owns = owned.join(firsts, ["digest", "doc_id"], "left").withColumn(
        "first", F.when(F.col("is_first"), F.col("least.n")).otherwise(0)
    )
    copy = 1 << (len(LETTERS) - 1)
    passing = F.struct(F.col("mask"), F.col("first").alias("n"))
    copies = F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("first")).alias("n"))
    out = owns.select("part", "good", "toxic", F.explode(F.array(passing, copies)).alias("of")).select(
        "part", "good", "toxic", "of.mask", "of.n"
    )
    out = out.unionByName(groups.where("NOT some").select("part", "good", "toxic", "mask", "n"))
    return out.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def intervals(mask: int, k: int) -> list[tuple[int, int, int]]:
    """(step, first rank, rank after the last) of the orders of ``k`` filters in which a mask goes at that step."""
    out = []

    def walk(left: list[int], step: int, rank: int) -> None:
        width = math.factorial(len(left) - 1)
        for i, letter in enumerate(left):
            start = rank + i * width
            if mask >> letter & 1:
                out.append((step, start, start + width))
            else:
                walk(left[:i] + left[i + 1 :], step + 1, start)

    if mask:
        walk(list(range(k)), 0, 0)
    return out


def orders(k: int) -> np.ndarray:
    """All orders by rank: the digits of each rank pick from the letters left."""
    out = []
    for rank in range(math.factorial(k)):
        left, order = list(range(k)), []
        for width in (math.factorial(j) for j in range(k - 1, -1, -1)):
            digit, rank = divmod(rank, width)
            order.append(left.pop(digit))
        out.append(order)
    return np.array(out, dtype=np.int64)


def audit(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Per part, order of the filters and step (from 1): what the step keeps and removes, all as counts.

    ``counted`` is a histogram with bit ``i`` of ``mask`` set where filter
    ``letters[i]`` fails. ``redundant``: fail the step's filter, but went before;
    ``unique_fails``: fail it alone; ``shapley``: removed by it at any step, over
    all orders. Parts without a row give none.
    """
    k = len(letters)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        by_rank = orders(k)
        masks = rows["mask"].to_numpy()
        counts = rows[["n", "good", "toxic"]].to_numpy(dtype=np.int64)
        edges = np.zeros((3, k, len(by_rank) + 1), dtype=np.int64)
        for mask, count in zip(masks, counts):
            for step, start, end in intervals(int(mask), k):
                edges[:, step, start] += count
                edges[:, step, end] -= count
        removed, good, toxic = np.cumsum(edges, axis=2)[:, :, :-1].transpose(0, 2, 1)
        n = counts[:, 0]
        failing = np.array([n[masks >> i & 1 == 1].sum() for i in range(k)])
        alone = np.array([n[masks == 1 << i].sum() for i in range(k)])
        shapley = np.array([removed[by_rank == i].sum() for i in range(k)])
        names = np.array(["".join(letters[i] for i in order) for order in by_rank])
        return pd.DataFrame(
            {
                "part": rows["part"].iloc[0],
                "filter_order": np.repeat(names, k),
                "step": np.tile(np.arange(1, k + 1, dtype=np.int32), len(names)),
                "kept": (n.sum() - np.cumsum(removed, axis=1)).ravel(),
                "removed": removed.ravel(),
                "redundant": (failing[by_rank] - removed).ravel(),
                "unique_fails": alone[by_rank].ravel(),
                "good_lost": good.ravel(),
                "toxic_lost": toxic.ravel(),
                "shapley": shapley[by_rank].ravel(),
            }
        )

    return counted.groupBy("part").applyInPandas(run, AUDIT)
