"""Quality classifier: cumulative-link regression on graded ratings.

The grades are ordered (0: toxic, 1: poor, 2: good). One weight vector over hashed
features of a text gives its score; ordered thresholds cut the score into grades:
``P(grade <= k) = sigmoid(threshold k - score)``. The expected grade ranks documents and
the probability of the top grades selects them.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.storage import neutral, stored

WORDS_BITS = 18  # buckets for words and their beginnings
STYLE = 4096  # buckets for letter shapes and for bins of document measures
STYLE_SCALE = 10.0
SAMPLE = 12_000  # rated documents the weights are fitted to, at most
FEATURES = 5_000_000  # of these documents together, so that long ones do not fill the driver
ITERATIONS = 200
PENALTY = 2e-3
LEAST_ROWS = 3  # of the sample that a feature must be in
SOFTEN = 0.2  # added to a feature's share of rows when features are scaled to equal spread
SELECT = 0.5  # of the probability of the top grade
MEMO = 300_000  # words whose features a task remembers

# Executors get this code with their tasks; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SHAPE = bytes(
    120 if 97 <= b <= 122 or b >= 128 else 88 if 65 <= b <= 90 else 57 if 48 <= b <= 57 else b
    for b in range(256)
)


def word_features(word: bytes) -> tuple[int, int, int, int]:
    """Buckets of the lower-cased word, of two beginnings of it, and of its shape."""
    low = word.lower()
    mask = (1 << WORDS_BITS) - 1
    shape = word.translate(_SHAPE)
    short = bytes(b for i, b in enumerate(shape) if i < 2 or not (b == shape[i - 1] == shape[i - 2]))
    return (
        zlib.crc32(b"w" + low) & mask,
        zlib.crc32(b"p" + low[:4]) & mask,
        zlib.crc32(b"q" + low[:6]) & mask,
        (1 << WORDS_BITS) + zlib.crc32(short[:12]) % STYLE,
    )


def measures(text: bytes, words: list[bytes], distinct: int) -> list[int]:
    """Buckets of the document's own measures: length, repeated words, repeated lines."""
    lines = text.split(b"\n")
    base = (1 << WORDS_BITS) + STYLE
    return [
        base + min(31, len(words).bit_length()),
        base + 32 + int(10 * distinct / max(1, len(words))),
        base + 48 + int(10 * len(set(lines)) / len(lines)),
    ]


DIMENSIONS = (1 << WORDS_BITS) + STYLE + 64


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def grades(self, score: np.ndarray) -> np.ndarray:
        """Probability of each grade, a row per score."""
        below = 1 / (1 + np.exp(np.clip(score[:, None] - self.thresholds[None, :], -500, 500)))
        edges = np.hstack([np.zeros((len(score), 1)), below, np.ones((len(score), 1))])
        return np.diff(edges, axis=1)


def grade(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, grade) from ``quality`` and ``toxic``; the lowest of repeated ratings holds.

    Rows with a null id or rating are left out.
    """
    of = F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality") + 1)
    return (
        labels.select(F.col(id_col).alias("_id"), of.alias("grade"))
        .filter("_id is not null and grade is not null")
        .groupBy("_id")
        .agg(F.min("grade").cast("int").alias("grade"))
    )


def _featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for text in frame["text"]:
            raw = (text or "").encode()
            words = raw.split()
            distinct = set(words)
            found = [word_features(w) for w in distinct]
            style, n = np.unique([x[3] for x in found], return_counts=True)
            own = measures(raw, words, len(distinct))
            at = np.concatenate([[f for x in found for f in x[:3]], style, own])
            # Words count one each; only the values behind them are sent.
            value = np.concatenate([STYLE_SCALE * n / max(1, len(found)), np.ones(len(own))])
            rows.append((at.astype(np.int32).tobytes(), value.astype(np.float32).tobytes()))
        yield frame[["key", "grade"]].assign(at=[a for a, _ in rows], value=[v for _, v in rows])


def fit(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
    features: int = FEATURES,
):
    """A ``Model`` from at most ``sample`` rated documents; None without two grades.

    The sample is the rated ids with the smallest hashes, as many as have ``features``
    features together, so it is the same in each run and for each order of the rows. Whole
    texts become features in the tasks and are stored; the driver takes those of the sample,
    whose number both bounds hold, however long the texts are.
    """
    chosen = ratings.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    featured = stored(
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
        .join(chosen, "_id")
        .select(F.xxhash64("_id").alias("key"), "grade", "text")
        .mapInPandas(_featured, "key bigint, grade int, at binary, value binary"),
        "ordinal-features",
    )
    sizes = featured.groupBy("key").agg(F.sum(F.octet_length("at") / 4).alias("n")).toPandas()
    sizes = sizes.sort_values("key")
    within = sizes["key"][sizes["n"].cumsum() <= features]
    last = int(within.iloc[-1]) if len(within) else -(2**63)
    rows = featured.filter(F.col("key") <= last).drop("key").toPandas()
    if rows["grade"].nunique() < 2:
        return None
    rows = rows.sort_values(["grade", "at"])  # the sums below then add up in one order
    grades, (at, value, begin) = rows["grade"].to_numpy(), _sparse(rows)
    del rows
    return _solve(grades, at, value, begin)


def _sparse(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all rows one after another, their values, and where each row begins.

    Features of fewer than LEAST_ROWS rows are left out here, before anything is computed.
    """
    at = np.frombuffer(b"".join(rows["at"]), np.int32)
    ends = np.cumsum(rows["at"].map(len).to_numpy() // 4)
    tails = rows["value"].map(len).to_numpy() // 4
    value = np.ones(len(at), np.float32)
    place = np.arange(tails.sum()) - np.repeat(np.cumsum(tails) - tails, tails)
    value[np.repeat(ends - tails, tails) + place] = np.frombuffer(b"".join(rows["value"]), np.float32)
    own = np.arange((1 << WORDS_BITS) + STYLE, DIMENSIONS)  # measures stay, so no row is empty
    often = np.bincount(at, minlength=DIMENSIONS) >= LEAST_ROWS
    often[own] = True
    keep = often[at]
    begin = np.concatenate([[0], np.cumsum(keep)[ends[:-1] - 1]])
    return at[keep].astype(np.int64), value[keep], begin


def _solve(grades: np.ndarray, at: np.ndarray, value: np.ndarray, begin: np.ndarray) -> Model:
    top = int(grades.max())
    lengths = np.diff(np.append(begin, len(at)))
    share = np.clip([(grades <= k).mean() for k in range(top)], 0.01, 0.99)
    cuts = np.log(share / (1 - share))
    # Ordered by construction: the first threshold and the logarithms of the steps to the next.
    free = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 0.1))])
    # Features are scaled to about equal spread; those of very few documents are left out,
    # as they would only learn these by heart. Accelerated gradient steps, whose size comes
    # from the largest curvature of the features (power iteration).
    rows = len(grades)
    seen = np.bincount(at, minlength=DIMENSIONS)
    usual = np.bincount(at, value, DIMENSIONS) / np.maximum(seen, 1)
    scale = np.where(seen >= LEAST_ROWS, 1 / (np.maximum(usual, 1e-6) * np.sqrt(seen / rows + SOFTEN)), 0.0)
    value = value * scale.astype(np.float32)[at]

    def forth(w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w.astype(np.float32)[at] * value, begin).astype(np.float64)

    def back(by_row: np.ndarray) -> np.ndarray:
        return np.bincount(at, np.repeat(by_row.astype(np.float32), lengths) * value, DIMENSIONS) / rows

    direction = np.bincount(at, value, DIMENSIONS)
    for _ in range(8):
        direction = back(forth(direction / np.linalg.norm(direction)))
    rate = 2.0 / np.linalg.norm(direction)
    weights, ahead, momentum = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 1.0
    row = np.arange(rows)
    for _ in range(ITERATIONS):
        cuts = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
        score = forth(ahead)
        below = 1 / (1 + np.exp(np.clip(score[:, None] - cuts[None, :], -500, 500)))
        edges = np.hstack([np.zeros((rows, 1)), below, np.ones((rows, 1))])
        low, high = edges[row, grades], edges[row, grades + 1]
        p = np.maximum(high - low, 1e-12)
        moved = ahead - rate * (back(1 - low - high) + PENALTY * ahead)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = moved + (momentum - 1) / after * (moved - weights)
        weights, momentum = moved, after
        by_cut = np.array(
            [
                ((low * (1 - low) / p)[grades == k + 1].sum() - (high * (1 - high) / p)[grades == k].sum()) / rows
                for k in range(top)
            ]
        )
        free = free - np.concatenate([[by_cut.sum()], [np.exp(free[k]) * by_cut[k:].sum() for k in range(1, top)]])
    cuts = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
    return Model((weights * scale).astype(np.float32), cuts)


class _Memo(dict):
    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: bytes) -> tuple[float, float]:
        if len(self) >= MEMO:
            self.clear()
        a, b, c, s = word_features(word)
        w = self.weights
        self[word] = made = (float(w[a]) + float(w[b]) + float(w[c]), float(w[s]))
        return made


def score(docs: DataFrame, model: Model | None, text_col: str = "text", select: float = SELECT) -> DataFrame:
    """``docs`` plus ``_expected_grade``, ``_top_probability`` and ``_kept``.

    Whole texts are scored; null counts as empty, and an empty text is scored by its
    measures alone. Without a model (no ratings, or one grade only) nothing is known:
    both figures are null and every row is kept. Rows are scored one by one, so repeated
    ones get equal figures; columns pass unchanged, but those called like a result give way
    to it. Empty in, empty out.
    """
    if model is None:
        return docs.withColumns(
            {
                "_expected_grade": F.lit(None).cast("double"),
                "_top_probability": F.lit(None).cast("double"),
                "_kept": F.lit(True),
            }
        )
    # Its size is fixed: DIMENSIONS floats. Plain arrays, as classes of this package are not
    # known to executors that lack it.
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    @F.pandas_udf("expected double, top double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Model(*shared.value)
        memo = _Memo(known.weights)
        for texts in batches:
            scores = np.empty(len(texts))
            for i, text in enumerate(texts):
                raw = (text or "").encode()
                words = raw.split()
                found = [memo[w] for w in set(words)]
                own = known.weights[measures(raw, words, len(found))].sum()
                style = sum(s for _, s in found) / max(1, len(found))
                scores[i] = sum(sorted(x for x, _ in found)) + STYLE_SCALE * style + own
            p = known.grades(scores)
            yield pd.DataFrame({"expected": p @ np.arange(p.shape[1]), "top": p[:, -1]})

    return (
        docs.withColumn("_scored", scored(text_col))
        .withColumns(
            {
                "_expected_grade": F.col("_scored.expected"),
                "_top_probability": F.col("_scored.top"),
                "_kept": F.col("_scored.top") >= select,
            }
        )
        .drop("_scored")
    )


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return score(docs, fit(docs, grade(labels, id_col), id_col, text_col), text_col)


def select(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps. Any column names will do."""
    plain, own_id, own_text = neutral(docs, id_col, text_col)
    model = fit(plain, grade(labels, id_col), own_id, own_text)
    kept = score(plain, model, own_text).filter("_kept")
    return kept.select(*plain.columns).toDF(*docs.columns)
