"""Mixing, classifier, secrets, fingerprints, language model, token files: small tables."""

import hashlib
import json
import math
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from inkfold.llm import hmm, imatch, mixing, ordinal, queries, secret_scan, token_files
from tests.llm.cases import CLASHING, awkward, prose, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# Mixing


def brute_targets(words):
    order = sorted((s for s in words if s is not None)) + ([None] if None in words else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(words.values()), set()
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(2 * words[s] for s in full)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 2 * words[s]}
        if not over:
            return share | {s: 2.0 * words[s] for s in full}
        full |= over


def test_mixing_with_clashing_columns_and_repeated_ids(spark):
    """Rows that share id and size but not the text get the same copies in each layout."""
    rows = [(i % 3, f"w{i} b c", "z", f"s{i % 2}", 0) for i in range(60)]
    docs = table(spark, rows).withColumns({"_mix_size": F.lit("z"), "_mix_chunk": F.lit("z")})
    found = []
    for parts in (1, 3, 6):
        made = mixing.plan(docs.repartition(parts))
        assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "_mix_chunk", *mixing.RESULTS]
        found.append(sorted((r["text"], r["_mix_copies"], r["_mix_chunk"]) for r in made.collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == 60


def test_mixing_plan(spark):
    rng = random.Random(3)
    rows = [(i, prose(i, rng.randint(1, 300)), "en", "abcdé"[i % 5 if i % 3 else 0], None) for i in range(600)]
    rows += [(700 + i, prose(i, 20), None, None, None) for i in range(40)] + awkward()
    planned = mixing.plan(table(spark, rows)).collect()
    assert len(planned) == len(rows)
    words = defaultdict(int)
    for r in planned:
        words[r["source"]] += r["_mix_size"]
    want = brute_targets(words)
    taken = defaultdict(int)
    for r in planned:
        assert r["_mix_size"] == len((r["text"] or "").encode().split())
        assert r["_mix_words"] == words[r["source"]]
        assert r["_mix_target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["_mix_copies"] <= 2
        assert abs(r["_mix_copies"] - r["_mix_rate"]) < 1
        taken[r["source"]] += r["_mix_copies"] * r["_mix_size"]
    largest = defaultdict(int)
    for r in planned:
        largest[r["source"]] = max(largest[r["source"]], r["_mix_size"])
    for source, target in want.items():
        rate = sum(r["_mix_rate"] * r["_mix_size"] for r in planned if r["source"] == source)
        assert rate == pytest.approx(target, rel=1e-5)
        assert abs(taken[source] - target) <= largest[source] / 2 + 1
    again = mixing.plan(table(spark, rows).repartition(7)).collect()
    by = lambda rs: sorted((str(r["doc_id"]), r["_mix_size"], r["_mix_copies"]) for r in rs)
    assert by(again) == by(planned)


def test_mixing_rates_tilt_exponentially(spark):
    rows = [(i, prose(i, 10 + i), "en", "a" if i < 100 else "b", None) for i in range(130)]
    planned = [r for r in mixing.plan(table(spark, rows)).collect() if r["_mix_rate"] < 2]
    for source in "ab":
        logs = [math.log(r["_mix_rate"]) / r["_mix_size"] for r in planned if r["source"] == source and r["_mix_size"]]
        assert not logs or max(logs) - min(logs) < 1e-9


def test_mix_repeats_rows(spark):
    docs = table(spark, schema=CLASHING)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert 0 < mixed.count() <= 2 * docs.count()
    assert mixing.mix(table(spark, [])).collect() == []


# Classifier


def _rated(n, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = prose(seed * 100_000 + i, 80).split()
        kind = i % 3
        if kind == 0:
            for at in rng.sample(range(80), 4):
                words[at] = rng.choice(["vileword", "nastyterm", "awfulname"])
        if kind == 1:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words), "en", "a", None))
        labels.append((i, int(kind != 1), int(kind == 0)))
    return docs, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_classifier_held_out(spark):
    docs, labels = _rated(900)
    ratings = spark.createDataFrame(labels[:700] + [(0, None, None), (None, 1, 0), (1, 0, 0)], LABELS)
    found = ordinal.classify(table(spark, docs), ratings).collect()
    held = [r for r in found if r["doc_id"] >= 700]
    right = sum(r["_kept"] == (r["doc_id"] % 3 == 2) for r in held)
    assert right >= 0.97 * len(held)
    means = [np.mean([r["_expected_grade"] for r in held if r["doc_id"] % 3 == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]


def test_classifier_model():
    rng = np.random.default_rng(1)
    at, grades = [], []
    for i in range(300):
        grade = i % 3
        at.append(np.array([10 + grade, 100 + int(rng.integers(50))], np.int32))
        grades.append(grade)
    flat = np.concatenate(at)
    model = ordinal._solve(np.array(grades), flat, np.ones(len(flat), np.float32), np.arange(300) * 2)
    assert np.all(np.diff(model.thresholds) > 0)
    p = model.grades(np.linspace(-9, 9, 50))
    assert np.allclose(p.sum(1), 1) and np.all(p >= 0)
    assert np.all(np.diff(p @ np.arange(3)) > 0)


def test_classifier_awkward(spark):
    docs = table(spark, schema=CLASHING)
    none = spark.createDataFrame([], LABELS)
    assert ordinal.select(docs, none).count() == docs.count()
    few = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (9, 1, 1), (4, 1, 0), (7, 1, 0)], LABELS)
    kept = ordinal.select(docs, few)
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    assert ordinal.select(table(spark, []), few).collect() == []


# Secrets

BASE = [
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)),
    ("access", re.compile("AKIA[A-Z0-9]+")),
    ("hex", re.compile("[0-9a-f]+")),
]
LEAST = {"assign": 6, "access": 20, "hex": 24}


def brute_base(text):
    found = []
    for place, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text):
            if len(m.group(2) if kind == "assign" else m.group()) >= LEAST[kind]:
                found.append((m.start(), place, m.end(), kind))
    return sorted(found)


def test_secret_base_spans(spark, tmp_path):
    rng = random.Random(8)
    hexa = "".join(rng.choices("0123456789abcdef", k=40))
    texts = [
        f"password = 'abcdef' token:{hexa} x",
        "secret=token=abcdef password: token: abcdefgh API_KEY=12345 apikey='123456'",
        "😀 AKIA" + "A1" * 8 + " AKIASHORT AKIAAKIA" + "Z9" * 9,
        hexa * 3 + " " + "é" * 30 + "deadbeef" * 3,
        "a" * 23 + " " + "b" * 24,
        "token = " * 50,
    ]
    rows = [(50 + i, t, None, None, None) for i, t in enumerate(texts)] + awkward()
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op5_randomness_secrets(spark, str(tmp_path)).collect()
    want = []
    for i, t, *_ in rows:
        spans = brute_base(t or "")
        joined = ",".join(f"{k}:{b}:{e}" for b, _, e, k in spans)
        n = Counter(k for *_, k in spans)
        want.append((i, n["assign"], n["access"], n["hex"], hashlib.sha256(joined.encode()).hexdigest()))
    got = [tuple(r)[:5] for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_randomness_battery(spark):
    rng = random.Random(4)
    letters = secret_scan.ALPHABETS[64]
    keys = ["".join(rng.choices(letters, k=40)) for _ in range(30)]
    plain = [
        "".join(prose(i, 14).split())[:40] for i in range(300)
    ] + ["abcdefghijklmnopqrstuvwxyz0123456789ABCD", "0" * 40, "01" * 20, "AbAbAbAbAbAbAbAbAbAbAbAbAbAb"]
    rows = [(i, f"see {k} here", None, None, None) for i, k in enumerate(keys + plain)]
    found = {r["id"]: r["spans"] for r in secret_scan.scan(table(spark, rows)).collect()}
    hits = [i for i, spans in found.items() if any(s["kind"] == "random" for s in spans)]
    assert sum(i < 30 for i in hits) >= 27
    assert sum(i >= 30 for i in hits) <= 3
    span = next(s for s in found[hits[0]] if s["kind"] == "random")
    assert (span["start"], span["end"]) == (4, 44)
    assert secret_scan.scan(table(spark, [])).collect() == []


def test_randomness_alphabets(spark):
    """Keys of every alphabet and length pass the tests of randomness and are found."""
    rng = random.Random(9)
    lower, upper, digits = (secret_scan.ALPHABETS[64][i:j] for i, j in ((26, 52), (0, 26), (52, 62)))
    alphabets = {
        "base36": digits + lower,
        "BASE36": digits + upper,
        "base32": lower + "234567",
        "letters": upper + lower,
        "base58": secret_scan.ALPHABETS[58],
        "base62": digits + upper + lower,
        "base64url": upper + lower + digits + "-_",
        "HEX": "0123456789ABCDEF",
        "lower": lower,
        "UPPER": upper,
    }
    keys = [
        (name, n, "".join(rng.choices(letters, k=n)))
        for name, letters in alphabets.items()
        for n in (24, 32, 40, 64, 128)
        for _ in range(40)
    ]
    for _ in range(40):
        raw = "".join(rng.choices("0123456789abcdef", k=32))
        keys.append(("uuid", 36, "-".join(raw[i:j] for i, j in ((0, 8), (8, 12), (12, 16), (16, 20), (20, 32)))))
        keys.append(("licence", 29, "-".join("".join(rng.choices(digits + upper, k=5)) for _ in range(5))))
    plain = [("prose", 0, "".join(prose(i, 60).split())[: rng.choice((30, 40, 90))]) for i in range(200)]
    plain += [("slug", 0, "-".join(prose(i, 12).split())) for i in range(200, 300)]
    plain += [("rule", 0, (c * 30)[:30]) for c in ("-", "=", "_", "+", "/", "a", "0", "A", "-=", "a" + "=" * 29, "a" + "-" * 29)]
    rows = [(i, f"see {k} here", None, None, None) for i, (*_, k) in enumerate(keys + plain)]
    tested = secret_scan.battery(spark.createDataFrame([(i, k) for i, (*_, k) in enumerate(keys)], "i int, match string"))
    passed, found = Counter(), Counter()
    for r in tested.collect():
        passed[keys[r["i"]][:2]] += min(r["_uniform"], r["_runs_p"], r["_serial_p"]) >= secret_scan.VETO
    assert min(passed.values()) >= 37
    assert len(passed) == 52
    for r in secret_scan.scan(table(spark, rows)).collect():
        found[(keys + plain)[r["id"]][:2]] += any(s["kind"] == "random" for s in r["spans"])
    # Digits are rare in base32 and letters in hex, so short keys do not alternate enough for some.
    weak = {k: found[k] for k in passed if k[0] not in ("lower", "UPPER") and found[k] < 34}
    assert all(k in (("base32", 24), ("HEX", 24)) and n >= 20 for k, n in weak.items()), weak
    assert found["lower", 128] >= 34 and found["UPPER", 128] >= 34
    assert found["prose", 0] + found["slug", 0] + found["rule", 0] <= 6


# Fingerprints


def test_fingerprints(spark, tmp_path):
    rows = [(100 + i, prose(i, 150), None, None, None) for i in range(200)] + awkward()
    docs = table(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op9_imatch(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[i].append(t or "")
    order = sorted((i for i in texts if i is not None), reverse=True) + [None]
    want = []
    for n, i in enumerate(order):
        other = min(texts[order[(n + 1) % len(order)]], key=str.encode)
        for t in texts[i]:
            k = len(t) // 3
            edited = t[: len(t) - k] + other[:k]
            want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, want))
    by_text = defaultdict(set)
    for r in imatch.fingerprints(docs).collect():
        by_text[tuple(sorted(texts[r["id"]]))].add(r["fingerprint"])
    assert all(len(v) == 1 for k, v in by_text.items() if len(k) == 1)
    own = [r for r in found if (r["doc_id"] or 0) >= 100]
    assert np.mean([r["near_edited"] for r in own]) > 0.15
    assert np.mean([r["near_next"] for r in own]) < 0.05
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    assert imatch.edited_likeness(table(spark, [])).collect() == []


def test_fingerprints_of_a_large_group(spark):
    """Near copies that hold a third of all rows are alike although their words are above the band."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, prose(i, 150), None, None, None) for i in range(200)]
    for i in range(200, 300):
        words = list(base)
        for at in rng.sample(range(200), 6):
            words[at] = f"edit{i}x{at}"
        rows.append((i, " ".join(words), None, None, None))
    found = {r["id"]: r for r in imatch.edited_likeness(table(spark, rows)).collect()}
    group = [found[i] for i in range(201, 300)]  # the next of 200 is no copy
    assert np.mean([r["near_next"] for r in group]) > 0.6
    assert np.mean([r["near_edited"] for r in group]) > 0.3
    assert np.mean([found[i]["near_next"] for i in range(1, 200)]) < 0.05
    assert len({r["fingerprint"] for r in group}) > 50


def test_frequencies_count_equal_sets_once(spark):
    rows = [(i, "one two" if i % 2 else "Two  one one", None, None, None) for i in range(50)]
    rows += [(50, "two three", None, None, None), (51, "", None, None, None), (52, None, None, None, None)]
    counted, sets = imatch.frequencies(table(spark, rows), "text")
    of = {r["w"]: r["h"] for r in spark.sql("select w, xxhash64(w) h from values ('one'), ('two'), ('three') t(w)").collect()}
    assert sets == 3
    assert {r["term"]: r["documents"] for r in counted.collect()} == {of["one"]: 1, of["two"]: 2, of["three"]: 1}


def test_documents_without_lexicon_terms(spark):
    """Common words alone do not make different documents equal, nor a changed rare one all else."""
    rows = [(i, f"page zz{i} of the long report", None, None, None) for i in range(1500)]
    found = imatch.edited_likeness(table(spark, rows)).agg(F.avg("near_next"), F.max("near_next")).first()
    assert 0.2 < found[0] < 1 and found[1] < 1


def test_likeness(spark):
    rows = [("1:a,b:a,b,c,-", "1:a,b:a,b,c,-", 1.0), ("1:a,-:x,x,x,x", "1:a,c:y,y,y,y", 0.5), ("1:a,b:p,q,-,-", "2:p,z,-,-:k", 0.5), ("x:1", "x:2", 0.0), ("1:a,b:c,d,e,f", "3:a,b:c,d", 0.0)]
    df = spark.createDataFrame(rows, "a string, b string, want double")
    for r in df.select("want", imatch.likeness(F.col("a"), F.col("b")).alias("got")).collect():
        assert r["got"] == r["want"]


# Language model


def test_forward_is_exact():
    rng = np.random.default_rng(2)
    emit = np.full((hmm.CLASSES, hmm.STATES), 1e-3) * rng.uniform(0.5, 1.5, (hmm.CLASSES, hmm.STATES))
    step = rng.dirichlet(np.ones(hmm.STATES), hmm.STATES)
    begin = rng.dirichlet(np.ones(hmm.STATES))
    model = hmm.Model(begin, begin, step, emit)
    texts = [rng.integers(0, hmm.CLASSES, n).astype(np.uint16) for n in (1, 4, 3, 4)]

    def paths(text):
        vector = begin * emit[text[0]]
        for t in text[1:]:
            vector = (vector @ step) * emit[t]
        return math.log10(vector.sum())

    assert hmm.forward(model, texts) == pytest.approx([paths(t) for t in texts])


def test_expected_counts_by_enumeration():
    import itertools

    rng = np.random.default_rng(3)
    emit = np.full((hmm.CLASSES, hmm.STATES), 1e-9)
    emit[:3] = rng.dirichlet(np.ones(3), hmm.STATES).T
    step, begin = rng.dirichlet(np.ones(hmm.STATES), hmm.STATES), rng.dirichlet(np.ones(hmm.STATES))
    model = hmm.Model(begin, rng.dirichlet(np.ones(hmm.STATES)), step, emit)
    stream, lengths = np.array([1, 0, 2, 1, 0]), np.array([1, 3, 1])
    first = np.array([True, True, False])
    into = {"begin": np.zeros(hmm.STATES), "inside": np.zeros(hmm.STATES), "step": np.zeros((hmm.STATES,) * 2), "emit": np.zeros((hmm.CLASSES, hmm.STATES))}
    hmm.expected_counts(model, stream, np.array([0, 1, 4]), lengths, first, into)
    want, seen, total = np.zeros((hmm.STATES,) * 2), np.zeros(hmm.STATES), 0.0
    for a, b, c in itertools.product(range(hmm.STATES), repeat=3):
        p = begin[a] * emit[0, a] * step[a, b] * emit[2, b] * step[b, c] * emit[1, c]
        want[a, b] += p
        want[b, c] += p
        seen[a] += p
        total += p
    alone = begin * emit[1] / (begin * emit[1]).sum()
    assert into["step"] == pytest.approx(want / total)
    assert into["begin"] == pytest.approx(seen / total + alone)
    assert into["emit"].sum() == pytest.approx(5) and into["inside"].sum() == pytest.approx(3)


def test_windows_lie_where_their_text_says():
    begins, lengths, first = hmm.windows(np.array([1, 64, 65, 130]))
    assert begins.tolist() == [0, 1, 65, 129, 130, 194, 258]
    assert lengths.tolist() == [1, 64, 64, 1, 64, 64, 2]
    assert first.tolist() == [True, True, True, False, True, False, False]


def test_scores_do_not_depend_on_the_layout(spark):
    rows = [(i, prose(i % 40, 3 + (17 * i) % 150), None, None, None) for i in range(300)] + awkward()
    found = []
    for parts in (1, 4, 7):
        scored = hmm.score(table(spark, rows).repartition(parts)).collect()
        found.append(sorted((str(r["id"]), r["n_tokens"], r["base_score"], r["score"]) for r in scored))
    for other in found[1:]:
        for a, b in zip(found[0], other):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=2e-6)  # counts come in units


WITHOUT_PACKAGE = r"""
import json, sys
sys.path.insert(0, sys.argv[1])
from inkfold.session import build_session
from inkfold.llm import fim, hmm, ordinal, runs, tag_paths
# Workers get a path without the repository.
spark = build_session("bare", "local[2]", **{"spark.executorEnv.PYTHONPATH": "", "spark.sql.shuffle.partitions": "2"})
sys.path.remove(sys.argv[1])
spark.sparkContext.environment["PYTHONPATH"] = ""
def found(_):
    import importlib.util
    return [importlib.util.find_spec("inkfold") is not None]
assert not any(spark.sparkContext.parallelize(range(2), 2).mapPartitions(found).collect()), "package on the path"
docs = spark.range(60).selectExpr("id as doc_id", "concat('w', id % 7, ' a b c d\n', repeat('x ', 8)) as text")
labels = spark.range(60).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "0 as toxic")
print(json.dumps([
    hmm.score(docs, iterations=1).count(), ordinal.select(docs, labels).count() >= 0, ordinal.classify(docs, labels).count(),
    fim.transform(docs).count(), runs.periodic(docs).count(),
    tag_paths.extract(docs.withColumnRenamed("text", "html")).filter("_main_text <> ''").count(),
]))
"""


def test_workers_need_not_have_the_package(tmp_path):
    root = str(Path(__file__).resolve().parents[2])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", WITHOUT_PACKAGE, root], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert json.loads(done.stdout.splitlines()[-1]) == [60, True, 60, 60, 60, 60]


def test_the_sample_is_bounded_by_its_features(spark):
    """Long texts: as many documents as have so many features together, the same in each run."""
    docs = table(spark, [(i, prose(i, 400), None, None, None) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], LABELS)
    ratings = ordinal.grade(labels)
    small = [ordinal.fit(docs.repartition(p), ratings, features=8_000) for p in (1, 5)]
    assert np.array_equal(small[0].weights, small[1].weights)
    assert 0 < np.count_nonzero(small[0].weights) < np.count_nonzero(ordinal.fit(docs, ratings).weights)
    assert ordinal.fit(docs, ratings, features=1) is None


def test_scores(spark, tmp_path):
    rng = random.Random(6)
    vocabularies = [[f"{p}{i}" for i in range(60)] for p in ("aa", "bb")]
    rows = [(i, " ".join(rng.choices(vocabularies[i % 2], k=60)), None, None, None) for i in range(300)] + awkward()
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op3_hidden_markov(spark, str(tmp_path)).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts, texts = Counter(), []
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split() + [b""]
        texts.append((i, w))
        if not held(i):
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    want = [
        (str(i), held(i), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6))
        for i, w in texts
    ]
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert sorted(got) == sorted(want)
    out = [r for r in found if r["held_out"] and r["n_tokens"] == 61]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert all(r["score"] < 0 for r in found)
    assert hmm.score(table(spark, [])).collect() == []


def test_model_is_a_distribution(spark):
    """Known words and one unknown event for each class add up to one."""
    rows = [(i, prose(i % 5, 30), None, None, None) for i in range(20)]
    training = table(spark, rows).select("text")
    counts = hmm.word_counts(training)
    vocab = hmm.vocabulary(counts)
    model = hmm.train(training, vocab, 2)
    assert model.emit.sum(0) == pytest.approx(np.ones(hmm.STATES))
    of = vocab.classes()
    inside = np.zeros(hmm.CLASSES)
    for w, n in vocab.counts.items():
        c = of[w]
        inside[c] += 1 if c < hmm.OWN else (n + 1) / 10 ** vocab.share[c]
    inside[hmm.OWN :] += 1 / 10 ** vocab.share[hmm.OWN :]
    used = vocab.class_tokens[: hmm.OWN] > 0
    assert inside[: hmm.OWN][used] == pytest.approx(np.ones(used.sum()))
    assert inside[hmm.OWN :] == pytest.approx(np.ones(hmm.SHARED))


# Token files


def test_token_files(spark, tmp_path):
    rows = awkward() + [(20, "tab\tand  nbsp end\r\n\r\nx", None, None, None), (21, "<|endoftext|> a", None, None, None)]
    folder = f"{tmp_path}/files"
    token_files.write(table(spark, rows, CLASHING), folder, TOKENIZER, 2)
    library = Tokenizer.from_file(TOKENIZER)
    library.encode_special_tokens = True
    encoded = defaultdict(list)
    for i, t, *_ in rows:
        encoded[i].append(library.encode(t or "", add_special_tokens=False).ids + [2])
    found = token_files.read(spark, folder).orderBy("start").collect()
    assert [r["id"] for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in found:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert r["start"] == start and r["n_tokens"] == len(ids) and ids in encoded[r["id"]]
        start += len(ids)
    assert sorted(map(len, sum(encoded.values(), []))) == sorted(r["n_tokens"] for r in found)
    assert [x.tolist() for x in token_files.fetch(spark, folder, 9)] == encoded[9]
    assert sorted(x.tolist() for x in token_files.fetch(spark, folder, 7)) == sorted(encoded[7])
    assert token_files.fetch(spark, folder, 999) == []


def test_token_files_as_the_library(spark, tmp_path):
    """The query's ids are those of the tokenizer as it comes, special tokens in texts included."""
    texts = ["<|endoftext|> a", "a b<|endoftext|>\n c d", " <|endoftext|><|endoftext|> ", "<|endoftext| >", "plain text"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(TOKENIZER)
    want = [library.encode(t, add_special_tokens=False).ids + [queries.END] for t in texts]
    assert 50256 in want[0]
    found = queries.op2_token_files(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in found] == list(map(len, want))
    assert [r["ids_crc32"] for r in found] == [zlib.crc32(np.array(w, "<u4").tobytes()) for w in want]


def test_token_files_dictionary(spark, tmp_path):
    docs = table(spark, [(i, prose(i, 30), None, None, None) for i in range(400)])
    folder = f"{tmp_path}/files"
    token_files.write(docs, folder, TOKENIZER, 2)
    size = (tmp_path / "files" / "dictionary").stat().st_size
    assert 0 < size <= token_files.DICTIONARY
    stored = {r["dictionary"] for r in spark.read.parquet(f"{folder}/manifest").collect()}
    assert stored == {hashlib.sha256((tmp_path / "files" / "dictionary").read_bytes()).hexdigest()}
    (tmp_path / "files" / "dictionary").write_bytes(b"other")
    with pytest.raises(ValueError):
        token_files.fetch(spark, folder, 5)


def test_token_files_empty(spark, tmp_path):
    folder = f"{tmp_path}/files"
    token_files.write(table(spark, []), folder, TOKENIZER, 2)
    assert token_files.read(spark, folder).collect() == []
