"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates that give
each source its target of words, those closest in entropy to one copy each are wanted.
The convex dual has one multiplier per source; the rate of a document is
``min(cap, exp(multiplier * size / mean size of its source))``. Newton's method finds the
multipliers. Rates depend on source and size alone, so its sums run over the counts of
(source, size) and never over documents. Rates are then rounded into whole copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkfold.functions.ranking import number_rows
from inkfold.llm.storage import discard, neutral, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
TOLERANCE = 1e-9  # of a source's target
STEPS = 60
LIMIT = 1e4  # multipliers stay within plus and minus this
UNIT = 1_000_000  # rates are rounded to whole millionths, so that their sums are exact
CHUNK = 4096  # documents whose rates are rounded together

_KEY = ["_mix_null", "_mix_source"]


def _sized(docs: DataFrame, text_col: str, source_col: str) -> DataFrame:
    return docs.withColumns(
        {
            "_mix_null": F.col(source_col).isNull(),
            "_mix_source": F.coalesce(F.col(source_col), F.lit("")),
            "_mix_size": F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("bigint"),
        }
    )


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sources`` (with ``_mix_words``) plus its target number of words, and if it is capped.

    A source takes ``weight * level`` words, at most ``cap`` times its own. The level rises
    until the targets add up; each round fixes the sources that the last level overfilled.
    """
    numbered = number_rows(sources, [], _KEY, "_mix_rank")
    table = F.array(*map(F.lit, weights))
    weighted = stored(
        numbered.withColumns(
            {
                "_mix_weight": F.element_at(table, ((F.col("_mix_rank") - 1) % len(weights) + 1).cast("int")),
                "_mix_most": F.col("_mix_words") * F.lit(cap),
            }
        ).drop("_mix_rank"),
        "mix-weights",
    )
    level, fixed = 0.0, -1
    while True:
        full = F.col("_mix_most") < F.col("_mix_weight") * F.lit(level)
        row = weighted.agg(
            F.sum("_mix_words").alias("all"),
            F.sum(F.when(full, F.col("_mix_most")).otherwise(0.0)).alias("taken"),
            F.sum(F.when(~full, F.col("_mix_weight")).otherwise(0.0)).alias("weight"),
            F.count_if(full).alias("fixed"),
        ).first()
        if row["fixed"] == fixed or not row["weight"]:
            break
        fixed = row["fixed"]
        level = ((row["all"] or 0) * share - row["taken"]) / row["weight"]
    return weighted.withColumns(
        {
            "_mix_target": F.least("_mix_most", F.col("_mix_weight") * F.lit(level)),
            "_mix_full": F.col("_mix_weight") * F.lit(level) >= F.col("_mix_most"),
        }
    ).drop("_mix_weight", "_mix_most")


def _rate(cap: float):
    tilted = F.exp(F.col("_mix_lambda") * F.col("_mix_size") / F.col("_mix_mean"))
    return (
        F.when(F.col("_mix_size") == 0, 1.0)
        .when(F.col("_mix_full"), cap)
        .otherwise(F.least(F.lit(cap), tilted))
    )


def _exact_sum(c):
    """Independent of the order of the rows, which sums of doubles are not."""
    return F.sum(c.cast("decimal(28,6)")).cast("double")


def solve(counts: DataFrame, sources: DataFrame, cap: float = CAP) -> DataFrame:
    """``sources`` plus their multipliers, by Newton steps on the dual, all sources at once.

    A step that leaves the interval known to hold the solution is replaced by halving it.
    """
    state = stored(
        sources.withColumns(
            {
                "_mix_mean": F.greatest(F.col("_mix_words") / F.col("_mix_docs"), F.lit(1e-12)),
                "_mix_lambda": F.lit(0.0),
                "_mix_low": F.lit(-LIMIT),
                "_mix_high": F.lit(LIMIT),
                "_mix_gap": F.lit(None).cast("double"),
            }
        ),
        "mix-state-0",
    )
    for step in range(1, STEPS + 1):
        rate = _rate(cap)
        words = F.col("_mix_n") * F.col("_mix_size")
        tilt = F.when(rate < cap, words * F.col("_mix_size") / F.col("_mix_mean") * rate).otherwise(0.0)
        sums = (
            counts.join(state.select(*_KEY, "_mix_full", "_mix_mean", "_mix_lambda"), _KEY)
            .groupBy(*_KEY)
            .agg(_exact_sum(words * rate).alias("_mix_got"), _exact_sum(tilt).alias("_mix_slope"))
        )
        less = F.col("_mix_got") < F.col("_mix_target")
        old = F.col("_mix_lambda")
        bounded = state.join(sums, _KEY, "left").withColumns(
            {
                "_mix_low": F.when(less, old).otherwise(F.col("_mix_low")),
                "_mix_high": F.when(~less, old).otherwise(F.col("_mix_high")),
                "_mix_gap": F.when(F.col("_mix_full") | (F.col("_mix_target") == 0), 0.0).otherwise(
                    F.abs(F.col("_mix_got") - F.col("_mix_target")) / F.col("_mix_target")
                ),
            }
        )
        newton = old + (F.col("_mix_target") - F.col("_mix_got")) / F.nullif(F.col("_mix_slope"), F.lit(0.0))
        inside = (newton > F.col("_mix_low")) & (newton < F.col("_mix_high"))
        middle = (F.col("_mix_low") + F.col("_mix_high")) / 2
        moved = F.when(F.col("_mix_gap") <= TOLERANCE, old).when(inside, newton).otherwise(middle)
        after = stored(
            bounded.withColumn("_mix_lambda", moved).select(*state.columns), f"mix-state-{step}"
        )
        worst = after.agg(F.max("_mix_gap")).first()[0]
        discard(state)
        state = after
        if worst is None or worst <= TOLERANCE:
            break
    return state.drop("_mix_low", "_mix_high", "_mix_gap")


RESULTS = ["_mix_size", "_mix_words", "_mix_target", "_mix_rate", "_mix_copies"]


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """``docs`` plus ``_mix_size``, ``_mix_words``, ``_mix_target``, ``_mix_rate``, ``_mix_copies``.

    A null text has no words; a null source is a source of its own, after the others.
    Documents without words keep rate 1: they cost nothing. Repeated rows are mixed like
    any others. An empty table gives an empty result. Other columns are carried along,
    whatever their names, but those called like a result give way to it.

    Copies: within chunks of a source, in descending size, the running sum of the rates'
    fractions is rounded, so every chunk is off by less than half its largest document,
    and the same rows give the same copies: equal sizes go by id, then by text.
    """
    docs = docs.select(*(docs[c] for c in docs.columns if c not in RESULTS))
    plain, own_id, own_text, own_source = neutral(docs, id_col, text_col, source_col)
    made = _planned(plain, own_id, own_text, own_source, weights, share, cap)
    return made.toDF(*docs.columns, *RESULTS)


def _planned(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share: float, cap: float
) -> DataFrame:
    sized = _sized(docs, text_col, source_col)
    counts = stored(
        sized.groupBy(*_KEY, "_mix_size").agg(F.count(F.lit(1)).alias("_mix_n")), "mix-counts"
    )
    sources = counts.groupBy(*_KEY).agg(
        F.sum(F.col("_mix_n") * F.col("_mix_size")).alias("_mix_words"),
        F.sum("_mix_n").alias("_mix_docs"),
    )
    solved = solve(counts, targets(stored(sources, "mix-sources"), weights, share, cap), cap)
    chunks = F.ceil(F.col("_mix_docs") / CHUNK)
    rated = sized.join(solved, _KEY).withColumns(
        {
            "_mix_rate": _rate(cap),
            "_mix_chunk": F.pmod(F.xxhash64(id_col), chunks),
        }
    )
    units = F.round(F.col("_mix_rate") * UNIT).cast("bigint")
    fraction = units % UNIT
    before = Window.partitionBy(*_KEY, "_mix_chunk").orderBy(
        F.desc("_mix_size"), id_col, F.xxhash64(text_col)
    )
    total = F.sum(fraction).over(before.rowsBetween(Window.unboundedPreceding, 0)) + UNIT // 2
    extra = F.floor(total / UNIT) - F.floor((total - fraction) / UNIT)
    return rated.withColumn("_mix_copies", (F.floor(units / UNIT) + extra).cast("bigint")).select(
        *docs.columns, *RESULTS
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """The rows of ``docs``, each as often as the plan says. Any column names will do."""
    plain, own_id, own_text, own_source = neutral(docs, id_col, text_col, source_col)
    planned = plan(plain, own_id, own_text, own_source, **options)
    repeated = planned.filter("_mix_copies > 0").withColumn(
        "_mix_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_mix_copies"))
    )
    return repeated.select(*plain.columns).toDF(*docs.columns)
