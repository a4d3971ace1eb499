"""Sets of word shingles, hashed to 64 bits, for code that runs in tasks."""

from __future__ import annotations

import sys

import numpy as np
import xxhash
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5  # of a shingle
MEMO = 300_000  # words whose hashes a task remembers

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = made = xxhash.xxh3_64_intdigest(word)
        return made


def words(text: str | None) -> list[bytes]:
    """Runs of bytes other than space and \\t..\\r, with A-Z lower-cased."""
    return (text or "").encode().lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; one for a shorter text, none without words."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if len(h) < WORDS:
        return mixed((h * _FACTORS[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    last = len(h) - WORDS + 1
    total = h[:last] * _FACTORS[0]
    for i in range(1, WORDS):
        total = total + h[i : i + last] * _FACTORS[i]
    return np.unique(mixed(total))
