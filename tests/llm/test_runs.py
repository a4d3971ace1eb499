"""Periodic runs against a search that tries every period."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkfold.llm import queries, runs
from tests.llm.cases import CLASHING, awkward, prose, table


def every_period(words, least=6, powers=4):
    """(start, length, period): for each period, the stretches where words so far apart agree."""
    smallest = {}
    for period in range(1, len(words) // powers + 1):
        i = 0
        while i + period < len(words):
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            if length >= max(least, powers * period):
                smallest.setdefault((start, start + length), period)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in smallest.items())


def texts():
    rng = random.Random(8)
    made = ["a a a a a", "a a a a a a", "x a b a b a b a b", "x a b a b a b a b a y", "a b c " * 50, "a " * 30_000]
    for _ in range(60):
        words = []
        while len(words) < rng.randint(5, 300):
            unit = rng.choices("abcde", k=rng.randint(1, 7))
            words += (unit * rng.randint(1, 9))[: rng.randint(1, 50)]
        made.append(rng.choice([" ", "\n", "\t "]).join(words))
    line = prose(3, 12) + "\n"
    made.append(line * 9 + prose(4, 50) + "\n" + line * 3)
    made.append((prose(9, 700) + " ") * 5)
    return [*awkward(), *((100 + i, t, "en", "a", len(t)) for i, t in enumerate(made))]


@pytest.mark.parametrize("least, powers", [(6, 4), (2, 3), (9, 5)])
def test_equals_every_period(spark, least, powers):
    rows = texts()
    made = runs.periodic(table(spark, rows, CLASHING), least=least, powers=powers)
    assert made.columns == [c.split()[0] for c in CLASHING.split(", ")] + runs.RESULTS
    found = made.collect()
    assert len(found) == len(rows) and all(r["_kept"] == "z" for r in found)
    known = {}
    for r in rows:
        words = (r[1] or "").encode().split()
        if len(words) < 8000:
            known[r[1]] = every_period(words, least, powers)
    for r in found:
        words = (r["text"] or "").encode().split()
        own = [tuple(x) for x in r["_runs"]]
        if r["text"] in known:
            assert own == known[r["text"]], r["text"][:200]
        gone = {i for s, n, q in own for i in range(s + q, s + n)}
        assert r["_collapsed"].encode().split() == [w for i, w in enumerate(words) if i not in gone]
    long = next(r for r in found if r["text"] == "a " * 30_000)
    assert [tuple(x) for x in long["_runs"]] == [(0, 30_000, 1)]
    assert long["_collapsed"] == "a"


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.lists(st.tuples(st.text("abc", min_size=1, max_size=5), st.integers(1, 9)), max_size=12), max_size=6),
    st.integers(1, 9),
    st.integers(3, 5),
)
def test_texts_ordered_together(parts, least, powers):
    docs = [[c.encode() for unit, times in doc for c in unit * times] for doc in parts]
    assert runs.find(docs, least, powers) == [every_period(d, least, powers) for d in docs]


def test_many_small_runs_with_different_words_before():
    words = [w for i in range(4000) for w in (b"w%d" % i, *[b"a"] * 7)]
    assert runs.find([words])[0] == [(8 * i + 1, 7, 1) for i in range(4000)]


def test_refuses_squares_and_takes_an_empty_table(spark):
    with pytest.raises(ValueError):
        runs.periodic(table(spark), powers=2)
    assert runs.periodic(table(spark, [])).collect() == []
    old = runs.periodic(table(spark).withColumn("_runs", F.lit("old")))
    assert old.columns.count("_runs") == 1


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query(spark, tmp_path):
    rows = [*texts(), *((1000 + i, prose(i, 5 + i), "en", "a", 1) for i in range(150))]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want, some = [], 0
    for r in rows:
        words = planted(r[0], r[1])
        if len(words) > 8000:
            continue
        found = every_period(words)
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        some += bool(best)
        want.append((
            r[0], len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
        ))
    made = queries.op13_maximal_pairs(spark, str(tmp_path))
    assert made.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    got = [str(tuple(r)) for r in made.collect()]
    assert len(got) == len(rows) and some > 30
    assert set(map(str, want)) <= set(got)
