"""A run-compressed Burrows-Wheeler index of many strings, for code that runs in tasks.

The transform is kept as its runs: where each begins, and how far its rows move when the
text is walked one byte back. Rows whose suffixes agree on ``length`` bytes are a class; where
classes begin, and the least owner in each, come from the whole order of suffixes, which is
not kept. No matching statistics are computed. Queries stream through the runs from their last byte to their
first; at each place the row gives the class of the string that begins there.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PACK = 7  # symbols of 9 bits in a 64-bit key


def _ranks(sorted_keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    new = np.concatenate([[0], sorted_keys[1:] != sorted_keys[:-1]])
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.cumsum(new) + 1
    return rank


class RunIndex:
    def __init__(self, strings: list[bytes], owners: np.ndarray, length: int):
        sizes = np.array([len(s) for s in strings])
        self.stops = np.cumsum(sizes + 1) - 1  # where each string's end mark is
        self.sizes, self.length = sizes, length
        raw = np.frombuffer(b"\x00".join(strings) + b"\x00", np.uint8)
        text = raw.astype(np.uint64) + np.uint64(1)
        text[self.stops] = 0
        n = len(text)
        self.left = np.repeat(self.stops, sizes + 1) - np.arange(n)  # bytes up to the end mark
        order = self._suffixes(text, int(sizes.max()) + 1)
        before = text[order - 1]  # the last end mark stands before the first string
        heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.runs = heads
        symbols = before[heads]
        lengths = np.diff(np.append(heads, n))
        # Rows of a symbol keep their order: a run moves as one, to behind those before it.
        by_symbol = np.argsort(symbols, kind="stable")
        target = np.empty(len(heads), np.int64)
        target[by_symbol] = np.cumsum(lengths[by_symbol]) - lengths[by_symbol]
        self.shift = target - heads
        self._classes(raw, order, owners)

    def _suffixes(self, text: np.ndarray, depth: int) -> np.ndarray:
        """All suffixes, compared up to their end marks; equal ones in order of place."""
        n = len(text)
        key = np.zeros(n, np.uint64)
        for i in range(_PACK):
            symbol = np.zeros(n, np.uint64)
            symbol[: n - i] = np.where(self.left[: n - i] >= i, text[i:], 0)
            key = key << np.uint64(9) | symbol
        have = _PACK
        while True:
            order = np.argsort(key)
            rank = _ranks(key[order], order)
            if have >= depth or int(rank.max()) == n:
                break
            behind = np.zeros(n, np.uint64)
            behind[: n - have] = np.where(self.left[: n - have] >= have, rank[have:], 0)
            key = rank << np.uint64(32) | behind
            have *= 2
        return np.argsort(rank << np.uint64(32) | np.arange(n, dtype=np.uint64))

    def _classes(self, raw: np.ndarray, order: np.ndarray, owners: np.ndarray) -> None:
        """Begin and least owner of each class of suffixes that share ``length`` bytes."""
        length = self.length
        rows = np.flatnonzero(self.left[order] >= length)
        at = order[rows]
        words = np.ndarray((max(0, len(raw) - 7),), "<u8", raw.tobytes(), strides=(1,))
        same = np.ones(max(0, len(at) - 1), bool)
        for i in [*range(0, length - 8, 8), length - 8]:
            value = words[at + i]
            same &= value[1:] == value[:-1]
        first = np.flatnonzero(np.concatenate([[True], ~same])) if len(at) else np.empty(0, np.int64)
        owner = owners[np.searchsorted(self.stops, at)]
        self.class_rows = rows[first]
        self.least = np.minimum.reduceat(owner, first) if len(first) else np.empty(0, np.int64)

    def back(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes one byte longer."""
        return rows + self.shift[np.searchsorted(self.runs, rows, "right") - 1]

    def stream(self):
        """For all strings at once, from the last byte on: (string numbers, place, least owner).

        A place is given where ``length`` bytes or more are left, so the class is known.
        """
        order = np.argsort(-self.sizes, kind="stable")
        sizes = self.sizes[order]
        rows = order.astype(np.int64)  # end marks come first, in order of the strings
        live = len(sizes)
        for step in range(1, int(sizes[0]) + 1):
            while sizes[live - 1] < step:
                live -= 1
            rows = self.back(rows[:live])
            if step >= self.length:
                found = np.searchsorted(self.class_rows, rows, "right") - 1
                yield order[:live], sizes[:live] - step, self.least[found]
