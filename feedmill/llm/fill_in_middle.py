"""Fill-in-the-middle by an indexable skip list over a text's units.

A text is cut into units (lines by default). The bottom lane of a skip list has
one link a unit; each lane above keeps a part of the nodes, picked by a hash of
their place, and its links carry two widths: how many units they pass over and
how many code points. To find the code point at which a rank of units begins,
the search goes along the top lane while the widths added up stay within the
rank, steps down, and goes on; on the bottom lane it stands exactly on the cut.
Two ranks a text cut it into prefix, middle and suffix, which are put out in one
of two orders behind marks.

One row is one text; nothing is grouped across rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One node in ``2 ** STEP_BITS`` of a lane is in the lane above too.
STEP_BITS = 3
LINE = r"[^\n]*\n|[^\n]+"

_MADE = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


@dataclass(frozen=True)
class Rule:
    """``unit``: a pattern whose matches tile any text; ``marks``: those of prefix, suffix and middle.

    Of 100 texts some ``rate`` are changed, and some ``spm`` of 100 changed ones have the suffix first.
    """

    seed: int = 7
    unit: str = LINE
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    rate: int = 100
    spm: int = 50


class SkipList:
    """``points``: the code points of each unit, in order."""

    def __init__(self, points: list[int]) -> None:
        self.n = len(points)
        units, points = np.ones(self.n, dtype=np.int64), np.array(points, dtype=np.int64)
        # A lane: units and points that each link passes over, and where its node stands on the lane below.
        self._lanes = [(units.tolist(), points.tolist(), None)]
        heights = self._heights(self.n)
        while len(points) > 1 << STEP_BITS:
            stays = heights >= len(self._lanes)
            stays[0] = True  # the head
            down = np.flatnonzero(stays)
            if len(down) == len(points):
                break
            units, points = np.add.reduceat(units, down), np.add.reduceat(points, down)
            self._lanes.append((units.tolist(), points.tolist(), down.tolist()))
            heights = heights[down]

    @staticmethod
    def _heights(n: int) -> np.ndarray:
        """How many lanes above the bottom each node reaches: its share of low zero bits in a hash of its place."""
        x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        low = (x ^ (x >> np.uint64(32))) | np.uint64(1 << 63)
        lowest = low & (~low + np.uint64(1))
        return np.log2(lowest.astype(np.float64)).astype(np.int64) // STEP_BITS

    def point(self, rank: int) -> int:
        """The code points of the first ``rank`` units."""
        passed = at = node = 0
        for units, points, down in reversed(self._lanes):
            while passed < rank and passed + units[node] <= rank:
                passed, at, node = passed + units[node], at + points[node], node + 1
            if passed == rank:
                return at
            if down is not None:
                node = down[node]
        raise IndexError(rank)


def draws(key: str, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def make(key: str, text: str, rule: Rule, unit: re.Pattern) -> tuple[int, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    lanes = SkipList([len(u) for u in unit.findall(text)])
    h = draws(key, rule.seed)
    if not text or any(m in text for m in rule.marks) or h[2] % 100 >= rule.rate:
        return lanes.n, "plain", None, None, text
    a, b = sorted((h[0] % (lanes.n + 1), h[1] % (lanes.n + 1)))
    cut, end = lanes.point(a), lanes.point(b)
    prefix, middle, suffix = text[:cut], text[cut:end], text[end:]
    p, s, m = rule.marks
    if h[3] % 100 < rule.spm:
        return lanes.n, "spm", cut, end - cut, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return lanes.n, "psm", cut, end - cut, f"{p}{prefix}{s}{suffix}{m}{middle}"


def transform(docs: DataFrame, rule: Rule = Rule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row, as struct ``row``, with struct ``fim``: ``n, form, prefix_chars, middle_chars, output``.

    The cuts follow from the key and the seed. A null or empty text is plain and
    empty, as is one that holds a mark unchanged; a null key counts as an empty
    one. Rows that repeat give equal results, an empty table an empty one, and
    other columns stay in ``row``.
    """

    @F.pandas_udf(_MADE)
    def fim(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        names, unit = [c.split()[0] for c in _MADE.split(", ")], re.compile(rule.unit)
        for keys, texts in batches:
            rows = [make(k, t, rule, unit) for k, t in zip(keys, texts)]
            made = pd.DataFrame(rows, columns=names)
            yield made.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    return docs.select(row.alias("row"), fim(name, whole).alias("fim"))


def restore(output: Column, form: Column, rule: Rule = Rule()) -> Column:
    """The text that an output of the given form was made from.

    A changed text holds no mark, so the first mark of a kind is the one put in.
    """
    p, s, m = rule.marks

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        one = F.substring_index(output, second, 1)
        rest = F.substr(output, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, m, 1)
        return F.substr(one, F.lit(len(first) + 1)), two, F.substr(rest, F.length(two) + len(m) + 1)

    prefix, suffix, middle = parts(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))
