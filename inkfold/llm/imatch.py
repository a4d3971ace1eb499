"""I-Match fingerprints over randomised lexicon subsets.

The lexicon is the terms whose document frequency lies in a band: common enough that a
document has many, rare enough to tell documents apart. Frequencies count documents with the
same terms once. A document keeps its distinct lexicon terms, sorted. Where more of its terms
lie above the band than in it, as in a large group of near copies, which lifts its own words
there, the rarest of those above are added until half of them all are kept.

The lexicon is split at random into ``2 ** scale`` subsets; the
fingerprint holds a hash of the document's terms in each of the first ``SLOTS`` of them. The
scale follows the number of terms, so that a subset has one or two: an edit then
changes the hashes of the subsets it touches and leaves the others. A second row of hashes
at the next finer scale lets documents at neighbouring scales be compared.

Everything is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.ranking import number_rows
from inkfold.llm.storage import stored

LEAST_SHARE = 0.001  # of all documents, for a term of the lexicon
MOST_SHARE = 0.05
SLOTS = 16
BROADCAST_TERMS = 2_000_000  # of a lexicon that is sent to all tasks, about 40 MB
LEAST_ID = -(2**63)  # stands for a null id

WHITE = r"[\x20\x09-\x0D]+"


def terms(text: Column) -> Column:
    """Sorted hashes of the distinct lower-cased words; empty for null."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), WHITE)
    distinct = F.array_distinct(F.filter(words, lambda w: w != ""))
    return F.sort_array(F.transform(distinct, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str) -> DataFrame:
    """(term, above) of the band and above it; ``above`` is null in the band, else the frequency.

    At most the mean number of terms of a document over LEAST_SHARE.
    """
    counted, documents = frequencies(docs, text_col)
    counted = stored(counted, "imatch-frequencies").filter(F.col("documents") >= LEAST_SHARE * documents)
    above = F.when(F.col("documents") > MOST_SHARE * documents, F.col("documents"))
    return stored(counted.select("term", above.alias("above")), "imatch-lexicon")


def frequencies(docs: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """(term, documents) over the distinct sets of terms, and how many sets there are."""
    held = docs.select(terms(F.col(text_col)).alias("terms")).withColumn("whole", F.xxhash64("terms"))
    sets = stored(held.groupBy("whole").agg(F.count(F.lit(1)).alias("rows")), "imatch-sets")
    repeated = sets.filter("rows > 1").select("whole", F.col("whole").alias("repeated"))
    if repeated.count() <= BROADCAST_TERMS:
        repeated = F.broadcast(repeated)
    # Rows whose set has no other are added up in the map tasks; a repeated set is one each.
    counted = (
        held.join(repeated, "whole", "left")
        .select("repeated", F.explode("terms").alias("term"))
        .groupBy("term", "repeated")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("term")
        .agg(F.sum(F.when(F.col("repeated").isNull(), F.col("rows")).otherwise(1)).alias("documents"))
    )
    return counted, sets.count()


def chosen(band: Column, above: Column, whole: Column) -> Column:
    """Sorted terms that a document keeps.

    ``band`` has its terms of the band, ``above`` those above it as (frequency, term), rarest
    first. Without any in the band, common terms alone would make different documents
    equal, so ``whole``, a hash of all its terms, is one more.
    """
    missing = F.ceil((F.size(above) - F.size(band)) / 2).cast("int")
    added = F.transform(F.slice(above, 1, missing), lambda x: x["term"])
    alone = F.when(F.size(band) == 0, F.array(whole)).otherwise(F.array().cast("array<bigint>"))
    return F.when(missing > 0, F.sort_array(F.concat(band, added, alone))).otherwise(band)


def _row(kept: Column, scale: Column) -> Column:
    """Hashes of the terms in each of the first subsets at ``scale``; ``-`` where none is."""
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), scale)
    inside = F.filter(
        F.transform(kept, lambda t: F.struct(F.pmod(F.xxhash64(t, F.lit(7)), size).alias("slot"), t.alias("term"))),
        lambda x: x["slot"] < SLOTS,
    )

    slots = F.sequence(F.lit(0), F.least(size, F.lit(SLOTS)) - 1)

    def one(held, slot):
        mine = F.transform(F.filter(held, lambda x: x["slot"] == slot), lambda x: x["term"])
        return F.when(F.size(mine) == 0, "-").otherwise(F.right(F.hex(F.xxhash64(mine)), F.lit(8)))

    # Inside an array of one, the chosen terms are computed once for all subsets.
    joined = F.transform(
        F.array(inside), lambda held: F.array_join(F.transform(slots, lambda slot: one(held, slot)), ",")
    )
    return joined[0]


def fingerprint(kept: Column, whole: Column) -> Column:
    """``scale:hashes:finer hashes`` of the sorted terms ``kept``.

    A document without any has ``x:`` and ``whole``, a hash of all its terms, so that only
    equal ones agree.
    """
    scale = F.floor(F.log2(F.size(kept))).cast("int")
    rows = F.concat_ws(":", scale.cast("string"), _row(kept, scale), _row(kept, scale + 1))
    return F.when(F.size(kept) == 0, F.concat(F.lit("x:"), F.hex(whole))).otherwise(rows)


def _kept(rows: DataFrame, known: DataFrame, sides: int) -> DataFrame:
    """(own, key, payload, times, kept_0, ..): the sorted terms that each side keeps.

    ``rows`` has own, key, arrays of terms side_0, .. and a payload with their hashes
    whole_0, ... A row's terms are
    exploded, joined with the lexicon and gathered again. Where the lexicon is broadcast,
    rows stay in the partition that they are in. Equal own and key are one row, ``times`` fold.
    """
    none = F.lit(None).cast(rows.schema["payload"].dataType)
    item = lambda side, term, payload: F.struct(
        F.lit(side).alias("side"), term.alias("term"), payload.alias("payload")
    )
    mark = F.array(item(-1, F.lit(None).cast("bigint"), F.col("payload")))
    # The lambda's number of arguments has a meaning, so the side is bound around it.
    of_side = lambda k: F.transform(f"side_{k}", lambda t: item(k, t, none))
    items = [of_side(k) for k in range(sides)]
    terms_of = rows.select("own", "key", F.inline(F.concat(mark, *items)))
    known = known.select("term", "above", F.lit(True).alias("known"))
    if known.count() <= BROADCAST_TERMS:
        known = F.broadcast(known)
    found = terms_of.join(known, "term", "left").filter("known or side = -1")
    gathered = lambda k, usual, value: F.array_distinct(
        F.sort_array(F.collect_list(F.when((F.col("side") == k) & usual, value)))
    )
    usual = F.col("above").isNull()
    return (
        found.groupBy("own", "key")
        .agg(
            F.first("payload", ignorenulls=True).alias("payload"),
            F.count_if(F.col("side") == -1).alias("times"),
            *(gathered(k, usual, F.col("term")).alias(f"band_{k}") for k in range(sides)),
            *(gathered(k, ~usual, F.struct("above", "term")).alias(f"above_{k}") for k in range(sides)),
        )
        .select(
            "own",
            "key",
            "payload",
            "times",
            *(
                chosen(F.col(f"band_{k}"), F.col(f"above_{k}"), F.col(f"payload.whole_{k}")).alias(f"kept_{k}")
                for k in range(sides)
            ),
        )
        .withColumn("_", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")))
        .drop("_")
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of subsets with equal hashes among those where either document has a term.

    1 for equal fingerprints; 0 where a document keeps no term or the scales are
    further apart than one.
    """
    p, q = F.split(a, ":"), F.split(b, ":")
    step = p[0].try_cast("int") - q[0].try_cast("int")
    x = F.when(step == 0, p[1]).when(step == -1, p[2]).when(step == 1, p[1])
    y = F.when(step == 0, q[1]).when(step == -1, q[1]).when(step == 1, q[2])
    pairs = F.filter(
        F.arrays_zip(F.split(x, ",").alias("x"), F.split(y, ",").alias("y")),
        lambda z: ~((z["x"] == "-") & (z["y"] == "-")),
    )
    same = F.size(F.filter(pairs, lambda z: z["x"].eqNullSafe(z["y"]))).cast("double")
    share = same / F.nullif(F.size(pairs), F.lit(0))
    return F.when(a == b, 1.0).otherwise(F.coalesce(share, F.lit(0.0)))


def neighbours(ids: DataFrame) -> DataFrame:
    """(own, next_id, to_id): the next smaller id, after the smallest the largest, and back.

    ``ids`` has one row per id. Numbers come from a range sort over many tasks.
    """
    numbered = stored(number_rows(ids, [], ["own"], "rank"), "imatch-ranks")
    n = numbered.count()
    place = lambda c, name: numbered.select(F.col("own").alias(name), c.alias("rank"))
    after = place(F.when(F.col("rank") == n, 1).otherwise(F.col("rank") + 1), "next_id")
    before = place(F.when(F.col("rank") == 1, n).otherwise(F.col("rank") - 1), "to_id")
    return numbered.join(after, "rank").join(before, "rank").select("own", "next_id", "to_id")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LEAST_ID)).alias("own"),
        F.xxhash64(text).alias("key"),
        text.alias("text"),
    )


def _id(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(LEAST_ID))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; ids are whole numbers.

    Equal texts have equal fingerprints. Null counts as empty. Frequencies count rows
    with the same terms once. An empty table gives an empty result.
    """
    rows = _rows(docs, id_col, text_col)
    known = lexicon(rows, "text")
    found = rows.select(
        "own",
        "key",
        terms(F.col("text")).alias("side_0"),
        F.struct(F.xxhash64(terms(F.col("text"))).alias("whole_0")).alias("payload"),
    )
    kept = _kept(found, known, 1)
    return kept.select(
        _id("own").alias("id"), fingerprint(F.col("kept_0"), F.col("payload.whole_0")).alias("fingerprint")
    )


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row against its text with the last third taken from the next document.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The next document is the one with the next smaller id; null ranks below all
    ids. Of rows that share an id the least text is taken. A single document is its own
    next. Every row of ``docs`` has one row; null texts count as empty; other columns are
    not read. An empty table gives an empty result.

    Texts pass one exchange, by id; it serves both sides of the join with the neighbour,
    whose other side carries only the beginnings that are asked for.
    """
    # The key comes after the joins: both sides then ask for the same columns and exchange.
    docs = _rows(docs, id_col, text_col).drop("key")
    known = lexicon(docs, "text")
    sizes = stored(
        docs.groupBy("own").agg(F.max(F.char_length("text")).alias("n"), F.count(F.lit(1)).alias("rows")),
        "imatch-sizes",
    )
    most = sizes.agg(F.max("rows")).first()[0]
    needs = sizes.select(F.col("own").alias("to_id"), F.floor(F.col("n") / 3).cast("int").alias("need"))
    links = stored(neighbours(sizes.select("own")).join(needs, "to_id"), "imatch-links")
    placed = docs.join(links.hint("merge"), "own")
    heads = placed.select(F.col("to_id").alias("own"), F.left("text", F.col("need")).alias("head"))
    if (most or 0) > 1:
        heads = heads.groupBy("own").agg(F.min("head").alias("head"))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = placed.join(heads.hint("merge"), "own").withColumn(
        "edited", F.concat(F.left("text", n - third), F.left("head", third))
    )
    rows = edited.select(
        "own",
        F.xxhash64("text").alias("key"),
        terms(F.col("text")).alias("side_0"),
        terms(F.col("edited")).alias("side_1"),
        "next_id",
        n.cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("sha"),
    )
    payload = F.struct(
        "next_id", "n_chars", "sha", F.xxhash64("side_0").alias("whole_0"), F.xxhash64("side_1").alias("whole_1")
    )
    kept = _kept(rows.withColumn("payload", payload), known, 2)
    made = stored(
        kept.select(
            "own",
            "payload.next_id",
            "payload.n_chars",
            F.col("payload.sha").alias("edited_sha256"),
            fingerprint(F.col("kept_0"), F.col("payload.whole_0")).alias("fingerprint"),
            fingerprint(F.col("kept_1"), F.col("payload.whole_1")).alias("edited_fingerprint"),
        ),
        "imatch-fingerprints",
    )
    of_next = made.select(F.col("own").alias("next_id"), F.col("fingerprint").alias("next_fingerprint"))
    if (most or 0) > 1:
        of_next = of_next.groupBy("next_id").agg(F.min("next_fingerprint").alias("next_fingerprint"))
    return made.join(of_next, "next_id").select(
        _id("own").alias("id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
