"""What a worker remembers of strings it has seen: a short list of ids for each, gathered without a loop."""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np

#: An order of the strings, the ids of all in one row in that order, and how many each has.
Made = tuple[np.ndarray, np.ndarray, np.ndarray]


def gather(ids: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Pieces of ``ids``, one after another: ``count`` of them from each ``start`` on."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return ids[np.arange(total) + np.repeat(start - (ends - count), count)]


class Memory:
    """At most ``most`` strings between calls. When there are more, the rarer half is forgotten."""

    def __init__(self, most: int, make: Callable[[list[str]], Made]) -> None:
        self._most, self._make = most, make
        self.known: dict[str, int] = {}
        self._start, self._count, self._uses = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self._ids = np.zeros(0, dtype=np.uint32)

    def _forget(self) -> None:
        """Keep the half of the strings that came up most."""
        kept = np.sort(np.argsort(-self._uses, kind="stable")[: self._most // 2])
        keep = np.zeros(len(self._uses), dtype=bool)
        keep[kept] = True
        self.known = {w: n for n, w in enumerate(w for w, old in self.known.items() if keep[old])}
        ids, count = self.gather(kept)
        self._ids, self._count, self._uses = ids, count, self._uses[kept] // 2
        self._start = np.cumsum(count) - count

    def numbers(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """A number for each of the distinct ``words``, which occur so many ``times``; good until the next call."""
        if len(self.known) > self._most:
            self._forget()
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            fresh = [words[k] for k in missing.tolist()]
            order, ids, count = self._make(fresh)
            numbers[missing[order]] = np.arange(len(self.known), len(self.known) + len(fresh))
            self.known.update(zip(map(fresh.__getitem__, order.tolist()), range(len(self.known), len(self.known) + len(fresh))))
            self._start = np.append(self._start, len(self._ids) + np.cumsum(count) - count)
            self._count, self._ids = np.append(self._count, count), np.append(self._ids, ids)
            self._uses = np.append(self._uses, np.zeros(len(fresh), dtype=np.int64))
        self._uses[numbers] += times
        return numbers

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids behind the numbers, in order, and how many each has."""
        count = self._count[numbers]
        return gather(self._ids, self._start[numbers], count), count
