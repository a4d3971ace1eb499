"""Exact dedup, near-dedup, repeats and BPE against brute force on awkward rows."""

import base64
import collections
import hashlib

import public_tokenizers
import pytest
import tiktoken

from inkfold.llm import bpe, chosen_path, exact_dedup, queries, repeats
from inkfold.llm.run_index import RunIndex
from tests.llm.cases import CLASHING, awkward, prose, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokens():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_exact_classes(spark):
    found = exact_dedup.classes(table(spark)).collect()
    by_text = collections.defaultdict(list)
    for r in awkward():
        by_text[r[1] or ""].append(r[0])
    assert len(found) == len(awkward())
    for r in found:
        ids = by_text[r["text"] or ""]
        known = [i for i in ids if i is not None]
        assert (r["_keep_id"], r["_group_size"]) == (max(known) if known else None, len(ids))
    assert sum(r["_kept"] for r in found) == len(by_text)


def test_exact_classes_with_clashing_columns(spark):
    names = "doc_id bigint, text string, _kept string, _keep_id string, _radix_n string, _radix_row string"
    rows = [(i, t, "z", "z", "z", "z") for i, t in ((1, "a"), (2, "a"), (3, "b"), (None, None))]
    found = exact_dedup.classes(spark.createDataFrame(rows, names))
    assert found.columns == ["doc_id", "text", "_radix_n", "_radix_row", "_keep_id", "_group_size", "_kept"]
    assert sorted((str(r["doc_id"]), str(r["_keep_id"]), r["_kept"], r["_radix_n"]) for r in found.collect()) == [
        ("1", "2", False, "z"), ("2", "2", True, "z"), ("3", "3", True, "z"), ("None", "None", True, "z"),
    ]


def test_exact_long_common_beginnings(spark):
    texts = ["a" * 5000, "a" * 5000, "a" * 4999 + "b", "a" * 4999, "a" * 600, "a" * 600 + "c", "a" * 600]
    found = exact_dedup.classes(table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]))
    assert {r["doc_id"]: r["_keep_id"] for r in found.collect()} == {0: 1, 1: 1, 2: 2, 3: 3, 4: 6, 5: 5, 6: 6}


def test_exact_deduplicate_keeps_columns(spark):
    docs = table(spark, schema=CLASHING)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert {r["_kept"] for r in kept.collect()} == {"z"}
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in awkward()})


def _sets(rows):
    made = []
    for doc_id, text, *_ in rows:
        w = (text or "").encode().lower().split()
        if len(w) >= 5:
            made.append((doc_id, frozenset(zip(*[w[k:] for k in range(5)]))))
        else:
            made.append((doc_id, frozenset([tuple(w)] if w else [])))
    return made


def _roots(rows):
    sets = _sets(rows)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    return sets, [find(i) for i in range(len(sets))]


def _components(rows):
    sets, roots = _roots(rows)
    least = collections.defaultdict(list)
    for (doc_id, _), root in zip(sets, roots):
        least[root].append(doc_id)
    out = []
    for (doc_id, s), root in zip(sets, roots):
        known = [x for x in least[root] if x is not None]
        out.append((doc_id, len(s), min(known) if known else None))
    return out


def _order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_near_groups(spark):
    found = chosen_path.groups(table(spark)).select("id", "n_shingles", "component_id").collect()
    assert _order(map(tuple, found)) == _order(_components(awkward()))


def test_near_large_group_that_must_branch(spark):
    """A family of which many pairs are just below the threshold, and a passage that all share."""
    import random

    rng = random.Random(5)
    base = prose(20, 100).split()
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(100), 6 if i < 90 else 12):
            words[at] = f"w{i}x{at}"
        rows.append((i, " ".join(words), None, None, None))
    shared = prose(21, 25)
    rows += [(1000 + i, shared + " " + prose(100 + i, 60), None, None, None) for i in range(80)]
    found = chosen_path.groups(table(spark, rows)).select("id", "n_shingles", "component_id").collect()
    assert _order(map(tuple, found)) == _order(_components(rows))


def _family(near, far):
    """Texts with one changed word in 100, and with three: those do not link to any."""
    import random

    rng = random.Random(8)
    base = prose(30, 100).split()
    rows = []
    for i in range(near + far):
        words = list(base)
        for at in rng.sample(range(5, 95), 1) if i < near else (10 + i % 15, 40 + i % 15, 70 + i % 15):
            words[at] = f"w{i}x{at}"
        rows.append((i, " ".join(words), None, None, None))
    return rows


def test_near_large_group_makes_few_pairs(spark, monkeypatch):
    """Outsiders of a family meet none of its members once these are connected."""
    made, candidates = [], chosen_path._candidates

    def counted(pairs, *rest):
        made.append(pairs.count())
        return candidates(pairs, *rest)

    monkeypatch.setattr(chosen_path, "_candidates", counted)
    rows = _family(110, 70)
    found = chosen_path.groups(table(spark, rows)).select("id", "n_shingles", "component_id").collect()
    assert _order(map(tuple, found)) == _order(_components(rows))
    assert sum(made) < 24 * len(rows)


def test_near_leaves_that_branch(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "FEW", 4)
    monkeypatch.setattr(chosen_path, "LEAF", 16)
    rows = _family(40, 30)
    found = chosen_path.groups(table(spark, rows)).select("id", "n_shingles", "component_id").collect()
    assert _order(map(tuple, found)) == _order(_components(rows))


def test_near_keep_one(spark):
    docs = table(spark, schema=CLASHING)
    kept = chosen_path.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    sets, roots = _roots(awkward())
    # The repeated row is one document of its component, and stays once.
    of = {root for (_, s), root in zip(sets, roots) if s}
    assert sum(1 for r in rows if (r["text"] or "").split()) == len(of)
    assert sum(1 for r in rows if not (r["text"] or "").split()) == 5


def brute_repeats(rows, length=50):
    rows = [(i if i is not None else -(2**63), (t or "").encode()) for i, t, *_ in rows]
    least = {}
    for i, b in rows:
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            least[w] = min(least.get(w, i), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if least[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i if i != -(2**63) else None, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats(spark, tmp_path):
    passage = prose(30, 60)
    rows = awkward() + [(100 + i, prose(200 + i, 30) + passage + prose(300 + i, 30), None, None, None) for i in range(30)]
    rows += [(200, "ab" * 300, None, None, None), (201, "ab" * 200 + "c", None, None, None), (202, "\0" * 120, None, None, None), (203, "\0" * 70, None, None, None)]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op1_run_index(spark, str(tmp_path)).collect()
    assert _text_order(map(tuple, found)) == _text_order(brute_repeats(rows))


def _text_order(rows):
    return sorted(rows, key=str)


def test_run_index_classes():
    strings = [b"abcabcabcd", b"xabcabcaby", b"abcabcabcd"]
    index = RunIndex(strings, __import__("numpy").array([5, 3, 7]), 8)
    found = {}
    for number, place, least in index.stream():
        for n, p, o in zip(number, place, least):
            found[(int(n), int(p))] = int(o)
    want = {}
    for n, s in enumerate(strings):
        for p in range(len(s) - 7):
            want[(n, p)] = min(o for t, o in zip(strings, [5, 3, 7]) if s[p : p + 8] in t)
    assert found == want
    assert len(index.runs) < sum(len(s) + 1 for s in strings)


@pytest.mark.parametrize("chunk,overlap", [(16_384, 256), (64, 16), (300, 40)])
def test_bpe_round_trip(spark, tokens, chunk, overlap):
    docs = table(spark, schema=CLASHING)
    found = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    assert found.columns == [c for c in docs.columns if c not in ("text", "ids")] + ["ids"]
    got = sorted((str(r["doc_id"]), r["ids"]) for r in found.collect())
    assert got == sorted((str(i), tokens.encode_ordinary(t or "")) for i, t, *_ in awkward())
    back = bpe.decode(found.select("doc_id", "ids"), RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r["doc_id"]), bytes(r["decoded"])) for r in back) == sorted(
        (str(i), (t or "").encode()) for i, t, *_ in awkward()
    )


def test_bpe_white_space_and_contractions_at_cuts(spark, tokens):
    texts = ["it's  we're\n\n\nthey'll   x" * 40, " " * 500 + "a", "'s" * 300, "é　 b " * 100, "12345 !?;" * 90]
    docs = table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    found = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=50, overlap=12).collect()
    assert {r["doc_id"]: r["ids"] for r in found} == {i: tokens.encode_ordinary(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize(
    "run",
    [
        lambda d: exact_dedup.deduplicate(d),
        lambda d: chosen_path.keep_one(d),
        lambda d: repeats.remove_repeats(d),
        lambda d: bpe.encode(d, RANKS, public_tokenizers.PATTERN),
    ],
)
def test_empty_table(spark, run):
    assert run(table(spark, [])).collect() == []


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, tmp_path, name):
    import duckdb

    table(spark).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    found = queries.QUERIES[name](spark, str(tmp_path))
    rows = [r for r in found.collect() if r["doc_id"] is not None]
    want = con.sql(f"select * from ({queries.ORACLES[name]}) where doc_id is not null")
    assert found.columns == want.columns
    # SQL counts a repeated row as kept each time; the operator keeps it once.
    plain = lambda rs: sorted(tuple(r)[:3] + tuple(r)[4:] for r in rs)
    assert plain(rows) == plain(want.fetchall())


def test_every_operator_has_a_query():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))


def test_run_index_keeps_what_it_reads():
    index = RunIndex([b"a" * 60, b"b" * 55], __import__("numpy").array([1, 2]), 50)
    assert set(vars(index)) == {"stops", "sizes", "length", "left", "runs", "shift", "class_rows", "least"}
