"""Lists of ids by string: what a worker has encoded already."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class IdLists:
    """The ids of strings met before lie in a row in one array; a dictionary
    tells a string's number, two arrays where its ids begin and how many they
    are. So the ids of any strings are gathered at once, by their numbers."""

    def __init__(self, limit: int, longest: int = 64):
        #: Strings kept; a full cache starts anew with those in use.
        self.limit = limit
        #: Longer strings are kept for the texts at hand only.
        self.longest = longest
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self._begin, self._size, self._ids = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint32)
        self._used = 0

    def __len__(self) -> int:
        return len(self.index)

    def __contains__(self, string: str) -> bool:
        return string in self.index

    def find(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """The strings, and the number of each (-1 of an unknown one)."""
        names = strings(column)
        return names, np.fromiter(map(self.index.get, names, repeat(-1)), np.int64, len(names))

    def add(self, strings: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Distinct unknown strings, with their ids in a row."""
        n, count, used = len(self.index), len(strings), self._used
        if n + count > len(self._begin):
            more = max(n + count, 2 * n)
            self._begin, self._size = np.resize(self._begin, more), np.resize(self._size, more)
        if used + len(ids) > len(self._ids):
            self._ids = np.resize(self._ids, max(used + len(ids), 2 * used))
        self._begin[n:n + count] = np.cumsum(sizes) - sizes + used
        self._size[n:n + count] = sizes
        self._ids[used:used + len(ids)] = ids
        self._used = used + len(ids)
        self.index.update(zip(strings, range(n, n + count)))

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the strings with these numbers in a row, how many each has)."""
        sizes = self._size[numbers]
        ends = np.cumsum(sizes, dtype=np.int64)
        at = np.repeat(self._begin[numbers] - ends + sizes, sizes)
        at += np.arange(len(at))
        return self._ids[at], sizes

    def trim(self, inuse: pa.Array) -> None:
        """Start anew with those of the distinct strings in use if the cache is full."""
        if len(self.index) >= self.limit:
            names, numbers = self.find(inuse)
            held = numbers >= 0
            ids, sizes = self.gather(numbers[held])
            self._reset()
            self.add([s for s, h in zip(names, held.tolist(), strict=True) if h], ids, sizes)

    def forget_long(self, since: int) -> None:
        """Drop the strings too long to keep of those added since there were
        ``since``, with their ids."""
        new = list(islice(self.index, since, None))
        short = np.array([len(s) <= self.longest for s in new], bool)
        if not short.all():
            ids, sizes = self.gather(since + np.flatnonzero(short))
            for s in new:
                del self.index[s]
            self._used = int(self._begin[since])
            self.add([s for s, x in zip(new, short.tolist(), strict=True) if x], ids, sizes)


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def pieces(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes of text."""
    piece = pc.cumulative_sum(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())).to_numpy() // size
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(texts)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)
