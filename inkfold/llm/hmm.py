"""A hidden Markov language model.

States emit word classes: every frequent word is a class of its own, the others share
classes by their last bytes, and inside a class a word has its smoothed share of the class's
training tokens. So the emission table has a fixed size, while the counts of words grow
with the corpus and stay a table. Baum-Welch counts are taken over windows of the training
texts in all partitions and added up by Spark; a window lies where its text says, so the
counts, and with them all scores, do not depend on how rows are dealt to tasks. The scaled
forward recursion over a whole text gives its exact likelihood.

An unknown word is one event of its class, as it is one event of the base model.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.shingles import words
from inkfold.llm.storage import stored

STATES = 8
OWN = 16_384  # most frequent words, with a class each
SHARED = 4_096  # classes of the others
HEAD = 200_000  # most frequent words whose counts every task holds; others are joined
SUFFIX = 3  # bytes that choose a shared class
WINDOW = 64  # tokens of a Baum-Welch window; the last one of a text is what is left
WINDOWS = 4096  # counted at a time in a task
ITERATIONS = 6
STICKY = 0.9  # probability of staying in a state, to begin with
PRIOR = 10.0  # tokens that every state is given from the overall distribution
UNIT = 2.0**20  # counts are added as whole multiples of 1 / UNIT: exact in any order
FLUSH = 400_000  # words counted in a task before they are passed on
END = b""  # the end of a text; no word is empty
FOLDS, HELD = 7, 2

CLASSES = OWN + SHARED

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fields(record) -> tuple:
    """A dataclass as plain values: executors that lack this package do not know its classes."""
    return tuple(vars(record).values())


def held_out(id_col: str):
    """Whether a row is kept from training, by the checksum of its id (null: of no text)."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % FOLDS == HELD


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) over all texts, ends included, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(made, names=["word", "n"])

        for batch in batches:
            for text in batch["text"]:
                counts.update(words(text.as_py()))
                counts[END] += 1
                if len(counts) > FLUSH:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    found = training.select("text").mapInArrow(run, "word binary, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What every task holds of the words: a fixed number of them, and the shared classes."""

    total: int  # training tokens
    distinct: int
    counts: dict[bytes, int]  # of the most frequent words, by falling count
    class_tokens: np.ndarray
    share: np.ndarray  # log10 of a shared class's denominator, 0 for own classes

    def classes(self) -> "_Classes":
        own = {w: i for i, w in zip(range(OWN), self.counts)}
        return _Classes(own)


class _Classes(dict):
    """Word to class; words with shared classes are remembered, up to a bound."""

    def __init__(self, own: dict[bytes, int]):
        super().__init__(own)
        self.own = own

    def __missing__(self, word: bytes) -> int:
        if len(self) > OWN + FLUSH:
            self.clear()
            self.update(self.own)
        made = self.own.get(word)
        if made is None:
            made = OWN + zlib.crc32(word[-SUFFIX:]) % SHARED
        self[word] = made
        return made


def _frequent(counts: DataFrame) -> DataFrame:
    """The most frequent words, HEAD at most: those above a limit that a histogram gives.

    No more than these rows come together; a sorted limit would send as many from each task.
    """
    bins = counts.groupBy(F.floor(F.log2("n") * 16).alias("bin")).agg(F.count(F.lit(1)).alias("words"))
    lowest, held = None, 0
    for row in sorted(bins.collect(), key=lambda r: -r["bin"]):  # sixteen for each power of two
        held += row["words"]
        if held > HEAD:
            break
        lowest = row["bin"]
    return counts.filter(F.floor(F.log2("n") * 16) >= (2**31 if lowest is None else lowest))


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    top = _frequent(counts).toPandas()
    order = sorted((-int(n), bytes(w)) for w, n in zip(top["word"], top["n"]))
    head = {w: -n for n, w in order}
    own = dict(zip(range(OWN), head.values()))
    last = F.substring("word", -SUFFIX, SUFFIX)
    shared = F.when(F.octet_length("word") < SUFFIX, F.col("word")).otherwise(last)
    by_class = (
        counts.groupBy((F.crc32(shared) % SHARED).cast("int").alias("at"))
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
        .toPandas()
    )
    tokens, members = np.zeros(CLASSES), np.zeros(CLASSES)
    tokens[OWN + by_class["at"].to_numpy(int)] = by_class["n"]
    members[OWN + by_class["at"].to_numpy(int)] = by_class["v"]
    for (i, n), word in zip(own.items(), head):
        at = OWN + zlib.crc32(word[-SUFFIX:]) % SHARED
        tokens[at] -= n
        members[at] -= 1
        tokens[i] = n
    share = np.zeros(CLASSES)
    share[OWN:] = np.log10(tokens[OWN:] + members[OWN:] + 1)
    return Vocabulary(int(total or 0), int(distinct), head, tokens, share)


@dataclass
class Model:
    begin: np.ndarray  # state of a text's first token
    inside: np.ndarray  # state of a window's first token inside a text
    step: np.ndarray  # from row to column
    emit: np.ndarray  # a row per class

    @staticmethod
    def first(vocab: Vocabulary) -> "Model":
        """Close to the overall distribution; seeded noise tells the states apart."""
        noise = np.random.default_rng(11).uniform(0.5, 1.5, (CLASSES, STATES))
        emit = (vocab.class_tokens + 1)[:, None] * noise
        step = np.full((STATES, STATES), (1 - STICKY) / (STATES - 1))
        np.fill_diagonal(step, STICKY)
        even = np.full(STATES, 1 / STATES)
        return Model(even, even, step, emit / emit.sum(0))

    @staticmethod
    def of(vocab: Vocabulary, begin, inside, step, emit) -> "Model":
        overall = (vocab.class_tokens + 1) / (vocab.class_tokens + 1).sum()
        emit = emit + PRIOR * overall[:, None]
        step, begin, inside = step + 1.0, begin + 1.0, inside + 1.0
        return Model(
            begin / begin.sum(), inside / inside.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0)
        )


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of texts that lie one after another: begins, lengths, whether a text begins."""
    each = -(-lengths // WINDOW)
    ends = np.cumsum(lengths)
    first = np.cumsum(each) - each
    number = np.arange(each.sum()) - np.repeat(first, each)
    begins = np.repeat(ends - lengths, each) + WINDOW * number
    return begins, np.minimum(WINDOW, np.repeat(ends, each) - begins), number == 0


def expected_counts(
    model: Model,
    stream: np.ndarray,
    begins: np.ndarray,
    lengths: np.ndarray,
    first: np.ndarray,
    into: dict[str, np.ndarray],
) -> None:
    """Add the expected counts of windows of ``stream`` to ``into``.

    ``first`` marks the windows at a text's beginning. Windows are taken by falling length,
    so those that are longer than t are the first ones at every step.
    """
    order = np.argsort(-lengths, kind="stable")
    begins, lengths, first = begins[order], lengths[order], first[order]
    live = len(lengths) - np.cumsum(np.bincount(lengths, minlength=lengths[0] + 1))
    alpha: list[np.ndarray] = []
    seen: list[np.ndarray] = []  # emissions over the step's scale
    tokens: list[np.ndarray] = []
    for t in range(lengths[0]):
        n = live[t]
        tokens.append(stream[begins[:n] + t])
        emitted = model.emit.take(tokens[t], 0)
        if t == 0:
            ahead = np.where(first[:, None], model.begin, model.inside)
        else:
            ahead = alpha[t - 1][:n] @ model.step
        joint = ahead * emitted
        scale = joint.sum(1, keepdims=True)
        alpha.append(joint / scale)
        seen.append(emitted / scale)
    beta = np.ones((0, STATES))
    gamma: list[np.ndarray] = []
    for t in range(lengths[0] - 1, -1, -1):
        # Windows that end here have nothing behind them.
        beta = np.concatenate([beta, np.ones((live[t] - len(beta), STATES))])
        gamma.append(alpha[t] * beta)
        if t:
            weighted = seen[t] * beta
            into["step"] += model.step * (alpha[t - 1][: live[t]].T @ weighted)
            beta = weighted @ model.step.T
    into["begin"] += gamma[-1][first].sum(0)
    into["inside"] += gamma[-1].sum(0)
    flat, weights = np.concatenate(tokens), np.concatenate(gamma[::-1])
    for k in range(STATES):
        into["emit"][:, k] += np.bincount(flat, weights[:, k], CLASSES)


def _sequences(training: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(classes): the class of every token of a text, its end last, as 16-bit numbers."""
    shared = training.sparkSession.sparkContext.broadcast(fields(vocab))  # HEAD words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Vocabulary(*shared.value).classes()
        for batch in batches:
            made = [
                np.fromiter(map(of.__getitem__, [*words(t.as_py()), END]), np.uint16).tobytes()
                for t in batch["text"]
            ]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["classes"])

    return training.select("text").mapInArrow(run, "classes binary")


def train(training: DataFrame, vocab: Vocabulary, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch over all texts of ``training``; counts meet in a table of CLASSES rows."""
    model = Model.first(vocab)
    if not vocab.total:
        return model
    sequences = stored(_sequences(training, vocab), "hmm-classes")
    columns = [f"c{k}" for k in range(STATES)]
    schema = ", ".join(["part string", "at int", *(f"{c} bigint" for c in columns)])

    def run(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
        into = {
            "begin": np.zeros(STATES),
            "inside": np.zeros(STATES),
            "step": np.zeros((STATES, STATES)),
            "emit": np.zeros((CLASSES, STATES)),
        }
        for batch in batches:
            raw = batch["classes"].to_pylist()
            stream = np.frombuffer(b"".join(raw), np.uint16).astype(np.int64)
            cut = windows(np.array([len(r) // 2 for r in raw], np.int64))
            for i in range(0, len(cut[0]), WINDOWS):
                expected_counts(model, stream, *(part[i : i + WINDOWS] for part in cut), into)
        for part, table in into.items():
            table = np.rint(np.atleast_2d(table) * UNIT).astype(np.int64)
            at = np.flatnonzero(table.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(at)), pa.array(at, pa.int32()), *map(pa.array, table[at].T.copy())],
                names=["part", "at", *columns],
            )

    for _ in range(iterations):
        counted = sequences.mapInArrow(lambda batches, model=model: run(batches, model), schema)
        sums = counted.groupBy("part", "at").agg(*(F.sum(c).alias(c) for c in columns)).toPandas()
        tables = {}
        for part, height in (("begin", 1), ("inside", 1), ("step", STATES), ("emit", CLASSES)):
            rows = sums[sums["part"] == part]
            tables[part] = np.zeros((height, STATES))
            tables[part][rows["at"].to_numpy(int)] = rows[columns].to_numpy(float) / UNIT
        model = Model.of(vocab, tables["begin"][0], tables["inside"][0], tables["step"], tables["emit"])
    return model


def forward(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of whole class sequences, by the scaled forward recursion."""
    order = np.argsort([-len(t) for t in texts], kind="stable")
    lengths = np.array([len(texts[i]) for i in order])
    stream = np.concatenate([texts[i] for i in order]).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    likelihood = np.zeros(len(texts))
    alpha = np.broadcast_to(model.begin, (len(texts), STATES))
    # How many texts are longer than t: a prefix of the texts, as they are sorted.
    live = len(texts) - np.cumsum(np.bincount(lengths, minlength=lengths[0] + 1))
    for t in range(lengths[0]):
        n = live[t]
        ahead = alpha[:n] if t == 0 else alpha[:n] @ model.step
        joint = ahead * model.emit.take(stream[begin[:n] + t], 0)
        scale = joint.sum(1)
        likelihood[:n] += np.log10(scale)
        alpha = joint / scale[:, None]
    out = np.empty(len(texts))
    out[order] = likelihood
    return out


def _scored(docs: DataFrame, vocab: Vocabulary, model: Model) -> DataFrame:
    """Scores without the words that tasks do not hold; those are listed with their number."""
    context = docs.sparkSession.sparkContext
    # HEAD words and CLASSES x STATES numbers.
    shared = context.broadcast((fields(vocab), fields(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model = Vocabulary(*shared.value[0]), Model(*shared.value[1])
        of = vocab.classes()
        held = {w: i for i, w in enumerate(vocab.counts)}
        # The last place stands for words that are not held.
        class_of = np.array([*(of[w] for w in held), 0], np.uint16)
        log_of = np.log10([*(n + 1 for n in vocab.counts.values()), 1])
        for batch in batches:
            if not batch.num_rows:
                continue
            sequences, sizes, known, own, shares, rest, numbers = [], [], [], [], [], [], []
            for text in batch["text"]:
                tokens = [*words(text.as_py()), END]
                at = np.fromiter(map(held.get, tokens, repeat(-1)), np.int64, len(tokens))
                classes, logged = class_of[at], log_of[at]
                others = np.flatnonzero(at < 0)
                unheld = Counter([tokens[i] for i in others])
                classes[others] = [of[tokens[i]] for i in others]
                sequences.append(classes)
                sizes.append(len(tokens))
                known.append(len(tokens) - sum(unheld.values()))
                own.append(float(logged.sum()))
                within = classes >= OWN
                shares.append(float(logged[within].sum() - vocab.share[classes[within]].sum()))
                rest.append(list(unheld))
                numbers.append(list(unheld.values()))
            likelihood = forward(model, sequences)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    batch["id"],
                    batch["held_out"],
                    pa.array(sizes, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(own, pa.float64()),
                    pa.array(likelihood + np.array(shares), pa.float64()),
                    pa.array(rest, pa.list_(pa.binary())),
                    pa.array(numbers, pa.list_(pa.int32())),
                ],
                names=["row", "id", "held_out", "n_tokens", "known", "own", "likelihood", "rest", "numbers"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        run,
        f"row bigint, id {kind}, held_out boolean, n_tokens bigint, known bigint, own double, "
        "likelihood double, rest array<binary>, numbers array<int>",
    )


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", iterations: int = ITERATIONS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The rows whose id's checksum leaves another remainder than the held-out one train the
    model. Null and empty texts are an end only. Repeated rows count and are scored each;
    a null id trains. Without training rows all words are unknown and states alike. An
    empty table gives an empty result. Other columns are not read; texts are taken whole.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        held_out(id_col).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    training = rows.filter(~F.col("held_out"))
    counts = stored(word_counts(training), "hmm-counts")
    vocab = vocabulary(counts)
    model = train(training, vocab, iterations)
    made = stored(_scored(rows, vocab, model), "hmm-rows")
    # Words that are frequent enough to be a hot key are held by the tasks, not joined here.
    tail = made.select("row", F.explode(F.arrays_zip("rest", "numbers")).alias("w")).select(
        "row", F.col("w.rest").alias("word"), F.col("w.numbers").alias("times")
    )
    sums = (
        tail.join(counts.hint("merge"), "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"),
            F.sum(F.col("times").cast("bigint")).alias("more"),
        )
    )
    logs = F.coalesce("logs", F.lit(0.0))
    each = math.log10(vocab.total + vocab.distinct + 1)
    return made.drop("rest", "numbers").join(sums, "row", "left").select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("bigint").alias("train_tokens"),
        (F.col("own") + logs - F.col("n_tokens") * each).alias("base_score"),
        (F.col("likelihood") + logs).alias("score"),
    )
