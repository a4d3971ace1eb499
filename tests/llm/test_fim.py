"""Fill-in-the-middle against a plain version, and the chunks it counts by."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkfold.llm import fim, queries
from tests.llm.cases import CLASHING, awkward, prose, table


def plain(doc_id, text, seed=7, rate=100, spm=50):
    """(units, form, prefix, middle, output), by one regular expression over the whole text."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(lines)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows():
    rng = random.Random(5)
    lines = [prose(i, rng.randint(0, 30)) for i in range(60)]
    texts = ["\n", "\n\n\n", "a\n", "a\nb", "\r\na\r", "x<P>y\nz", "ends <", "S>\nP>\n<M", "<\n<S\n>"]
    texts += ["\n".join(rng.choices(lines, k=rng.randint(1, 80))) for _ in range(40)]
    texts += ["é😀\n" * 3000, ("line " * 20 + "\n") * 2500, "ü" * 60_000, "a" * 50_000 + "\n"]
    made = [(100 + i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    return [*awkward(), *made]


def test_equals_the_plain_form_and_restores(spark):
    made = fim.transform(table(spark, rows(), CLASHING))
    assert made.columns == [c.split()[0] for c in CLASHING.split(", ")] + fim.RESULTS
    found = made.withColumn("_back", fim.restore("_fim_output", "_fim_form")).collect()
    want = sorted(str((r[0], r[1], *plain(r[0], r[1]))) for r in rows())
    assert sorted(str((r["doc_id"], r["text"], *(r[c] for c in fim.RESULTS))) for r in found) == want
    assert all(r["_back"] == (r["text"] or "") for r in found)
    assert {r["_fim_form"] for r in found} == {"plain", "psm", "spm"}
    assert all(r["_kept"] == "z" for r in found)


@pytest.mark.parametrize("rate, spm", [(0, 50), (40, 0), (100, 100)])
def test_rates(spark, rate, spm):
    found = fim.transform(table(spark, rows()), rate=rate, spm=spm, seed=3).collect()
    want = sorted(str(plain(r[0], r[1], 3, rate, spm)) for r in rows())
    assert sorted(str(tuple(r[c] for c in fim.RESULTS)) for r in found) == want


def test_an_input_column_called_like_a_result_gives_way(spark):
    made = fim.transform(table(spark).withColumn("_fim_output", F.lit("old")))
    assert made.columns.count("_fim_output") == 1
    assert made.filter("_fim_output = 'old'").isEmpty()


def test_empty_table(spark):
    assert fim.transform(table(spark, [])).collect() == []


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.sampled_from(["ab\n", "é", "😀", "\n", "long line of a text\n", "x" * 40]), max_size=200),
    st.integers(0, 250),
)
def test_cuts_by_chunks(parts, k):
    text = "".join(parts)
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    with pytest.MonkeyPatch.context() as m:
        # Chunks small enough that short texts have many.
        for name, value in (("LEAST", 4), ("MOST", 24), ("BITS", 3), ("BLOCK", 16)):
            m.setattr(fim, name, value)
        counted = fim.Lines(text, fim.Summaries(10, memory=200))
    assert counted.n == len(lines)
    assert counted.stop(min(k, len(lines))) == len("".join(lines[: min(k, len(lines))]))


def test_chunks_follow_the_content():
    shared = prose(3, 3000).encode()
    sets = []
    for lead in (b"", b"one", prose(4, 500).encode()):
        raw = lead + shared
        ends = [0, *fim.chunk_ends(np.frombuffer(raw, np.uint8))]
        assert ends[-1] == len(raw) and all(0 < b - a <= fim.MOST + 3 for a, b in zip(ends, ends[1:]))
        sets.append({raw[a:b] for a, b in zip(ends, ends[1:])})
    assert len(sets[0] & sets[1] & sets[2]) >= len(sets[0]) - 2


def test_a_chunk_is_summed_up_once():
    made = fim.Summaries(10)
    text = (prose(1, 900) + "\n") * 30
    fim.Lines(text, made)
    assert len(made) < 20  # of well over 100 chunks


def test_query(spark, tmp_path):
    table(spark, rows()).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op11_chunked_fim(spark, str(tmp_path)).collect():
        assert len(r["output_sha256"]) == 64
    digests = {
        (r["doc_id"], r["restored_sha256"])
        for r in queries.op11_chunked_fim(spark, str(tmp_path)).collect()
    }
    assert digests == {(r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows()}
