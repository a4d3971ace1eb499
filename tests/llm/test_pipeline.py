"""The pipeline: every stage on awkward rows, and the chain against its parts."""

import hashlib

import pytest

import corpus_pipeline
from tests.llm.cases import CLASHING, table
from tests.llm.test_figures import LABELS, _rated
from tests.llm.test_text_operators import _roots

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs, labels = _rated(700)
    good = [d for d in docs if d[0] % 3 == 2]
    copies = [(10_000 + d[0], *d[1:]) for d in good[:40]]
    near = [(20_000 + d[0], d[1] + " once more", *d[2:]) for d in good[40:80]]
    table(spark, docs + copies + near).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier",
        "exact_dedup",
        "near_dedup",
        "source_mixing",
        "byte_level_bpe",
    ]


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_takes_awkward_and_empty_rows(spark, folder, name):
    docs = table(spark, schema=CLASHING)
    out = STAGES[name](spark, docs, folder)
    if name == "byte_level_bpe":
        assert out.columns == [c for c in docs.columns if c not in ("text", "ids")] + ["ids"]
    else:
        assert out.columns == docs.columns
    assert out.count() <= 2 * docs.count()
    assert STAGES[name](spark, table(spark, []), folder).collect() == []


def test_chain(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = STAGES["quality_classifier"](spark, docs, folder)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    good = {r["doc_id"] for r in docs.collect() if r["doc_id"] % 10_000 % 3 == 2}
    assert len(ids & good) >= 0.97 * len(good) and len(ids - good) <= 0.03 * docs.count()
    one = STAGES["exact_dedup"](spark, kept, folder).collect()
    assert len(one) == len({hashlib.sha256(r["text"].encode()).digest() for r in kept.collect()})
    near = STAGES["near_dedup"](spark, table(spark, [tuple(r) for r in one]), folder).collect()
    _, roots = _roots([tuple(r) for r in one])
    assert len(near) == len(set(roots))
    done = corpus_pipeline.run(spark, folder)
    assert "text" not in done.columns and {r["doc_id"] for r in done.collect()} <= ids


def test_pipeline_is_registered():
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert ("pipeline" in __spark_entry__.oracle_sql()) == (corpus_pipeline.ORACLE_SQL is not None)


def test_bench_times_every_query():
    import __spark_entry__
    import bench

    assert bench.timed([]) == list(__spark_entry__.queries())
    assert "pipeline" in bench.timed([])
    assert bench.timed(["op4_exact_dedup"]) == ["op4_exact_dedup"]
