"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.llm import (
    bpe,
    chosen_path,
    exact_dedup,
    fim,
    hmm,
    imatch,
    mixing,
    ordinal,
    repeats,
    runs,
    secret_scan,
    tag_paths,
    token_files,
)
from inkfold.llm.storage import documents
from inkfold.session import run_folder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 2


def op1_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the strings of earlier ones."""
    found = repeats.remove_repeats(documents(spark, sf_dir))
    sizes = F.transform("spans", lambda s: (s["stop"] - s["begin"]).cast("bigint"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token files hold for each document, from the files."""
    folder = run_folder(spark, "token-files")
    token_files.write(documents(spark, sf_dir), folder, TOKENIZER, END, special=True)
    return token_files.read(spark, folder).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likelihood of every text under the base model and the hidden Markov model."""
    return hmm.score(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of equal texts by MSD radix partitioning."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return exact_dedup.classes(docs).select(
        "doc_id",
        F.col("_keep_id").alias("keep_id"),
        F.col("_group_size").alias("group_size"),
        F.col("_kept").alias("kept"),
        F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("text_sha256"),
    )


SQL_OP4 = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""


def op5_randomness_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and those that the randomness tests add, in every document."""
    found = secret_scan.scan(documents(spark, sf_dir))
    kinds = secret_scan.KINDS

    def joined(spans):
        text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(text, ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] != kinds[-1])
    return found.select(
        F.col("id").alias("doc_id"),
        *(number(kind).alias(f"n_{kind}") for kind in kinds[:-1]),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op6_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of each document, and the words they take."""
    planned = mixing.plan(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return planned.select(
        "doc_id",
        F.col("_mix_size").alias("size"),
        F.col("_mix_words").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_copies") * F.col("_mix_size")).alias("taken"),
        F.col("_mix_copies").alias("copies"),
        F.col("_mix_rate").alias("rate"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids by overlapping chunks, and the bytes they decode to."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ids = bpe.encode(docs, RANKS, PATTERN).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "ids",
    )
    return bpe.decode(ids, RANKS, PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op8_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and probability of the top grade of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal.classify(docs, labels).select(
        "doc_id",
        F.col("_expected_grade").alias("expected_grade"),
        F.col("_top_probability").alias("top_probability"),
        F.col("_kept").alias("kept"),
    )


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    made = imatch.edited_likeness(documents(spark, sf_dir))
    return made.withColumnRenamed("id", "doc_id")


def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates over links of 0.75 and more."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return chosen_path.groups(docs).select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op11_chunked_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut at two of its line boundaries, and what is restored from the output."""
    made = fim.transform(documents(spark, sf_dir).select("doc_id", "text"))
    return made.select(
        "doc_id",
        F.col("_fim_units").alias("n"),
        F.col("_fim_form").alias("form"),
        F.col("_fim_prefix_chars").alias("prefix_chars"),
        F.col("_fim_middle_chars").alias("middle_chars"),
        F.sha2(F.encode("_fim_output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(fim.restore("_fim_output", "_fim_form"), "UTF-8"), 256).alias("restored_sha256"),
    )


SQL_OP11 = r"""
with texts as (select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as d
  from documents),
cut as (select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as u,
  cast('0x' || d[1:8] as bigint) as h1, cast('0x' || d[9:16] as bigint) as h2,
  cast('0x' || d[17:24] as bigint) as h3, cast('0x' || d[25:32] as bigint) as h4 from texts),
placed as (select *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a,
  greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100
    then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form from cut),
parts as (select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m,
  array_to_string(u[b + 1:], '') as s from placed)
select doc_id, len(u) as n, form,
  case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else t end) as output_sha256,
  sha256(p || m || s) as restored_sha256
from parts
""".replace("\\n", "\n")


def op12_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return tag_paths.extract(pages).select(
        "page_id",
        "url",
        F.col("_main_text").alias("text"),
        F.char_length("_main_text").cast("bigint").alias("n_chars"),
    )


def op13_maximal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of every text, one text in ten made periodic first."""
    planted = F.expr("""
        case when h % 10 = 0 and n > 0 then array_join(
          transform(sequence(0, n - 1), i -> words[if(i < a, i, a + (i - a) % p)]), ' ') else text end""")
    docs = (
        documents(spark, sf_dir)
        .select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
        .withColumn(
            "words",
            F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))),
        )
        .withColumns({"g": F.expr("h div 10"), "n": F.size("words")})
        .withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)")))
        .withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
        .select("doc_id", planted.alias("text"))
    )
    found = F.col("_runs")
    best = F.array_max(
        F.transform(found, lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    )
    line = F.transform(
        found,
        lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")),
    )
    return (
        runs.periodic(docs)
        .withColumn("best", best)
        .select(
            "doc_id",
            F.size(found).cast("bigint").alias("n_runs"),
            (-F.col("best.col2")).alias("start"),
            F.col("best.length").alias("length"),
            (-F.col("best.col3")).alias("period"),
            F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
            F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
            F.sha2(F.encode("_collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
        )
    )


QUERIES = {
    "op1_run_index": op1_run_index,
    "op2_token_files": op2_token_files,
    "op3_hidden_markov": op3_hidden_markov,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_randomness_secrets": op5_randomness_secrets,
    "op6_entropy_mix": op6_entropy_mix,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_ordinal_quality": op8_ordinal_quality,
    "op9_imatch": op9_imatch,
    "op10_chosen_path": op10_chosen_path,
    "op11_chunked_fim": op11_chunked_fim,
    "op12_tag_path_ratios": op12_tag_path_ratios,
    "op13_maximal_pairs": op13_maximal_pairs,
}

ORACLES = {"op4_exact_dedup": SQL_OP4, "op11_chunked_fim": SQL_OP11}
