"""Corpus preparation: five stages from ``documents`` to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept.
Null and empty texts, repeated rows, extra columns and empty tables have the results that
the operators' docstrings state; columns of ``docs`` pass every stage but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from inkfold.llm import bpe, chosen_path, exact_dedup, mixing, ordinal
from inkfold.llm.storage import stored

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose probability of the top grade is high enough; others go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal.select(docs, labels)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of equal texts."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicates."""
    return chosen_path.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the source weights ask for."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text."""
    return bpe.encode(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("source_mixing", mix),
    ("byte_level_bpe", encode),
]

# The classifier's weights and the joins' trees have no SQL form; tests/llm holds the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
