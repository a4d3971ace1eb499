"""Periodic runs of words by maximal pairs of a bottom-up LCP-interval tree.

Two occurrences of a string, d words apart, are a maximal pair if neither a word more on
the left nor one on the right keeps them equal. With a string of at least two distances the
words under both repeat with period d, and being maximal on both sides is just what makes
them a whole run: nothing has to be extended. So the runs of a text are its maximal pairs
whose distance is short enough for their length, each stretch with its least distance.

Pairs come from the intervals of the suffix order by common prefix, from the longest prefix
down. An interval joins the positions of its parts, the smaller part into the larger; pairs
between parts cannot be extended to the right. Positions are kept by left word: where all
of an interval have the same one, no pair in it is maximal, and the lists are only joined.
Else each position meets the nearest of the other part on either side, and the pair counts
if the left words differ. The nearest suffice: an occurrence between two that are a period
apart would give the string, and with it the run, a shorter period.

Suffixes are ordered by doubling, all texts of a slice at once, as arrays. Words of different
texts never compare equal. What no longer repeats inside its text leaves the doubling, and
positions without an equal neighbour that is near enough at any level leave the tree.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.storage import neutral

LEAST = 6  # words of a run
POWERS = 4  # periods of a run
SLICE = 200_000  # words of texts that are ordered together; a longer text stands alone
RESULTS = ["_runs", "_collapsed"]
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

# Executors get this code with their tasks; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = made = len(self)
        return made


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, and for each place in it where its class starts and how large it is."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(keys)))
    return order, np.repeat(starts, sizes), np.repeat(sizes, sizes)


class Ordered:
    """Suffix order of several texts.

    ``levels[k]`` names the stretch of 2^k words at each position, in order and equal just
    where the words are; each text is followed by an end that equals nothing.
    """

    def __init__(self, texts: list[list[bytes]], least: int, powers: int):
        numbers = Numbers()
        sizes = np.array([len(t) for t in texts], np.int64)
        words = np.fromiter(
            map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum())
        )
        owner = np.repeat(np.arange(len(texts)), sizes)
        at = np.arange(len(words)) + owner + 1
        self.begins = np.cumsum(sizes + 1) - sizes  # an end stands before each text, too
        total = len(words) + len(texts) + 1
        names = np.arange(-total, 0)  # ends; no two alike
        order, starts, counts = _ranked(owner * len(numbers) + words)
        names[at[order]] = starts
        self.levels = [names]
        self.near = np.zeros(total, bool)
        self._double(np.sort(at[order[counts > 1]]), least, powers, total)

    def _double(self, active: np.ndarray, least: int, powers: int, total: int) -> None:
        while len(active):
            k = len(self.levels) - 1
            names = self.levels[k]
            reach = 2 << k  # common prefixes at this level are shorter
            if reach > shortest(least, powers):
                self._mark(active, names[active], reach, powers)
            own = names[active]
            order, starts, counts = _ranked(own * (2 * total) + names[active + (1 << k)] + total)
            own = own[order]
            first = np.ones(len(own), bool)
            first[1:] = own[1:] != own[:-1]
            before = np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
            finer = names.copy()
            finer[active[order]] = own + starts - before
            self.levels.append(finer)
            active = np.sort(active[order[counts > 1]])

    def _mark(self, active: np.ndarray, names: np.ndarray, reach: int, powers: int) -> None:
        """Note the positions with an equal neighbour at a distance that a run could have."""
        order = np.argsort(names, kind="stable")
        at, names = active[order], names[order]
        close = (names[1:] == names[:-1]) & ((powers - 1) * (at[1:] - at[:-1]) < reach)
        self.near[at[1:][close]] = True
        self.near[at[:-1][close]] = True

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at a and b begin with in common."""
        length = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.levels))):
            names = self.levels[k]
            length[names[a + length] == names[b + length]] += 1 << k
        return length


def shortest(least: int, powers: int) -> int:
    """Least common prefix of the two occurrences of any run."""
    return min(max(least - q, (powers - 1) * q) for q in range(1, least + 1))


class Tree:
    """The walk up the intervals; ``found`` has (start, stop) -> least distance."""

    def __init__(self, left: list[int], least: int, powers: int):
        self.left, self.least, self.powers = left, least, powers
        self.found: dict[tuple[int, int], int] = {}

    def _pair(self, start: int, other: int, length: int) -> None:
        distance = other - start
        if length + distance >= self.least:
            key = (start, other + length)
            if distance < self.found.get(key, distance + 1):
                self.found[key] = distance

    def join(self, a: tuple, b: tuple, length: int) -> tuple:
        """Interval of two parts, each (positions, their left word or None where it varies)."""
        if len(a[0]) < len(b[0]):
            a, b = b, a
        (large, word), (small, other) = a, b
        if word is not None and word == other:
            large.extend(small)
            return large, word
        left, reach = self.left, length // (self.powers - 1)
        if word is not None:
            large.sort()
        for p in small:
            i = bisect_left(large, p)
            if i and p - large[i - 1] <= reach and left[p] != left[large[i - 1]]:
                self._pair(large[i - 1], p, length)
            if i < len(large) and large[i] - p <= reach and left[p] != left[large[i]]:
                self._pair(p, large[i], length)
        if 8 * len(small) < len(large):
            for p in small:
                insort(large, p)
        else:
            large.extend(small)
            large.sort()
        return large, None

    def walk(self, positions: list[int], common: list[int], shortest: int) -> None:
        """Suffixes in order, and what each has in common with the next."""
        stack: list[tuple[int, tuple]] = []
        for p, length in zip(positions, common):
            node = [p], self.left[p]
            if length < shortest:
                length = 0
            while stack and stack[-1][0] > length:
                depth, part = stack.pop()
                node = self.join(part, node, depth)
            if length and stack and stack[-1][0] == length:
                stack[-1] = length, self.join(stack[-1][1], node, length)
            elif length:
                stack.append((length, node))


def find(texts: list[list[bytes]], least: int = LEAST, powers: int = POWERS) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text, by start and period."""
    ordered = Ordered(texts, least, powers)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    near = np.flatnonzero(ordered.near)
    if not len(near):
        return found
    near = near[np.argsort(ordered.levels[-1][near])]
    common = np.append(ordered.common(near[:-1], near[1:]), 0)
    tree = Tree(ordered.levels[0][np.arange(-1, len(ordered.near) - 1)].tolist(), least, powers)
    tree.walk(near.tolist(), common.tolist(), shortest(least, powers))
    begins = ordered.begins.tolist()
    owners = np.searchsorted(ordered.begins, [s for s, _ in tree.found], "right") - 1
    for owner, ((start, stop), period) in zip(owners.tolist(), tree.found.items()):
        found[owner].append((start - begins[owner], stop - start, period))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run covers after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()
    return b" ".join([words[i] for i in kept])


def _scan(least: int, powers: int):
    def slices(texts: pa.Array) -> Iterator[list[list[bytes]]]:
        part, size = [], 0
        for text in texts:
            words = (text.as_py() or "").encode().split()
            if part and size + len(words) > SLICE:
                yield part
                part, size = [], 0
            part.append(words)
            size += len(words)
        yield part

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for texts in batches:
            runs, rest = [], []
            for part in slices(texts):
                found = find(part, least, powers)
                rest += [collapsed(w, r) for w, r in zip(part, found)]
                runs += [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found]
            yield pa.StructArray.from_arrays(
                [pa.array(runs, kind), pa.array(rest, pa.binary()).cast(pa.string())], ["runs", "rest"]
            )

    return F.arrow_udf(scan, f"struct<runs:{RUNS},rest:string>")


def periodic(
    docs: DataFrame, text_col: str = "text", least: int = LEAST, powers: int = POWERS
) -> DataFrame:
    """``docs`` with ``_runs``, sorted by start and period, and ``_collapsed``.

    Words are what space and \\t to \\r separate, numbered from 0. A run has at least
    ``least`` words and ``powers`` (3 or more) of its smallest periods, and no neighbouring
    word extends it. The collapsed text has the words that no run covers after its first
    period, joined by spaces. Null and empty texts have no runs and an empty collapsed text.
    Rows are treated one by one, so repeated rows have equal results; an empty table gives an
    empty one. Texts are taken whole; one is a row of one task, where it needs memory of some
    8 bytes a word and level of doubling (levels: as many as its longest repeat has bits).
    Columns pass unchanged, whatever their names, but those called like a result give way to
    it. Nothing is shuffled.
    """
    if powers < 3:
        raise ValueError("runs need at least three periods")
    docs = docs.select(*(docs[c] for c in docs.columns if c not in RESULTS))
    outer = [*docs.columns, *RESULTS]
    docs, text_col = neutral(docs, text_col)
    scanned = docs.withColumn("_found", _scan(least, powers)(F.col(text_col)))
    return scanned.select(*docs.columns, "_found.runs", "_found.rest").toDF(*outer)
