"""Which part of a text decides where equal strings of a length meet.

Every window of ``length`` bytes chooses the anchor of ``GRAM`` bytes with the least hash
inside it, the leftmost of equals. Equal windows choose equal anchors at equal places, so
all equal windows of a corpus meet where occurrences of one anchor meet. Neighbouring
windows mostly choose the same anchor; a context is the bytes of such a run of windows.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

from inkfold.llm.shingles import mixed

GRAM = 16

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LAST = np.uint64(2**64 - 1)


def _slide(x: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over every stretch of ``width`` values."""
    have = 1
    while have * 2 <= width:
        x = of(x[:-have], x[have:])
        have *= 2
    return of(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def gram_hashes(data: bytes) -> np.ndarray:
    """48-bit hashes of all grams of ``data``."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    tail = words[GRAM - 8 :]
    head = words[: len(tail)]
    made = mixed(head * np.uint64(0x9E3779B97F4A7C15) + mixed(tail * np.uint64(0xC2B2AE3D27D4EB4F)))
    return made >> np.uint64(16)


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams of all texts in a row, and where each text ends."""
    ends = np.cumsum([len(t) for t in texts])
    h = gram_hashes(b"".join(texts))
    # A gram that crosses the end of a text is never the least one of a window inside it.
    for back in range(1, GRAM):
        at = ends[:-1] - back
        h[at[(at >= 0) & (at < len(h))]] = _LAST
    return h, ends


def _windows(ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows begin that lie inside a text, and that text's number."""
    number = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: max(0, ends[-1] - length + 1)]
    inside = np.flatnonzero(np.arange(len(number)) + length <= ends[number])
    return inside, number[inside]


def chunks(texts: list[bytes], length: int, every: int) -> tuple[np.ndarray, ...]:
    """(text number, begin, end): windows from begin up to end, cut where content says so.

    A chunk is cut before a window whose first gram has a hash of one in ``every``, so
    equal stretches of texts have equal chunks but for their ends.
    """
    if sum(map(len, texts)) < length:
        return (np.empty(0, np.int64),) * 3
    h, ends = _grams(texts)
    at, number = _windows(ends, length)
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    new = h[at] % np.uint64(every) == 0
    new |= np.concatenate([[True], number[1:] != number[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    begin = np.concatenate([[0], ends[:-1]])[number[first]]
    return number[first], at[first] - begin, at[last] + 1 - begin


def contexts(texts: list[bytes], ranges: list[np.ndarray], length: int) -> tuple[np.ndarray, ...]:
    """(text number, begin, end, anchor) of the contexts of windows inside ``ranges``.

    ``ranges`` has rows (begin, end) of windows for each text; places count in their text.
    """
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    if sum(map(len, texts)) < length:
        return none
    h, ends = _grams(texts)
    width = length - GRAM + 1
    least = _slide(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    high = _slide(np.concatenate([edge, least, edge]), width, np.maximum)
    chosen = np.flatnonzero(high == h)
    begins = np.concatenate([[0], ends[:-1]])
    step = np.zeros(len(least) + 1, np.int64)
    for begin, part in zip(begins, ranges):
        step[begin + part[:, 0]] += 1
        step[begin + part[:, 1]] -= 1
    windows = np.flatnonzero(np.cumsum(step[:-1]))
    if not len(windows):
        return none
    number = np.searchsorted(ends, windows, "right")
    # A window takes the first chosen gram that has the least hash in it.
    value = least[windows]
    at = np.searchsorted(chosen, windows)
    wrong = np.flatnonzero(h[chosen[at]] != value)
    while len(wrong):
        at[wrong] += 1
        wrong = wrong[h[chosen[at[wrong]]] != value[wrong]]
    anchor = chosen[at]
    new = (anchor[1:] != anchor[:-1]) | (np.diff(windows) != 1) | (number[1:] != number[:-1])
    first = np.flatnonzero(np.concatenate([[True], new]))
    last = np.append(first[1:], len(windows)) - 1
    text = number[first]
    return text, windows[first] - begins[text], windows[last] + length - begins[text], h[anchor[first]]
