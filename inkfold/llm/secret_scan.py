"""Secret scan: patterns, and a battery of randomness tests for what they do not name.

Base spans come from three patterns. Other runs of 20 and more key characters are
candidates. For each, the smallest alphabet that holds it is inferred (digits,
hexadecimal, letters, base32 and base36 of one case, letters of both, base58, base62,
base64) and three tests ask whether it could be random in it: chi-squared uniformity, runs
about the middle of the alphabet, serial correlation. In digits and letters of one case
hyphens are separators and are left out; elsewhere they are the URL form of base64.
What passes them is weighed against ordinary text: how low its chi-squared is, and how often
lower case, upper case and digits alternate, for its length. The two p-values are combined
(Fisher), and Benjamini-Hochberg over all candidates of the corpus, by length band, holds
the share of false discoveries. Letters of one case do not alternate, so short keys of
them alone are not told from text. Everything is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfold.llm.storage import stored

# The base patterns, in the order in which their kinds are listed.
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 6

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
VETO = 0.001  # a test with a smaller p-value says: not random
COINCIDENCE = 0.065  # probability that two letters of ordinary text are equal
CHANGES = 0.1  # rate at which ordinary text changes between lower, upper and digits
FALSE_SHARE = 0.01  # of discoveries
BANDS = (32, 64)  # lengths at which a new band begins
BINS = 100  # of the p-value's decimal logarithm
DEEPEST = 3000  # last bin
ALPHABETS = {  # up to 36 of either case; 32 in upper case, the others in lower case
    10: "0123456789",
    16: "0123456789abcdef",
    26: "abcdefghijklmnopqrstuvwxyz",
    32: "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    36: "0123456789abcdefghijklmnopqrstuvwxyz",
    52: "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    58: "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz",
    62: "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    64: "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}


def _pieces(text: Column, pattern: str) -> Column:
    r"""Matches in order: how far each reaches past the one before, and its own text.

    ``\G`` ties every attempt to the end of the last match, so the text is read once; the
    lazy gap in front of the pattern makes the matches leftmost and non-overlapping.
    """
    whole = F.regexp_extract_all(text, F.lit(rf"\G[\s\S]*?(?:{pattern})"), F.lit(0))
    return F.transform(
        whole,
        lambda p: F.struct(
            F.char_length(p).alias("reach"),
            F.regexp_extract(p, rf"^[\s\S]*?({pattern})$", 1).alias("match"),
        ),
    )


def _phi(z: Column) -> Column:
    """Normal distribution function by a logistic approximation (absolute error 2e-4)."""
    z = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))
    return 1 / (1 + F.exp(-1.5976 * z - 0.070566 * z * z * z))


def battery(candidates: DataFrame, value: str = "match") -> DataFrame:
    """``candidates`` plus ``_alphabet``, the three randomness p-values and ``_p`` against text.

    Those with less than two characters besides padding and separators are left out.
    """
    bare = F.regexp_replace(F.rtrim(F.translate(value, "=", " ")), " ", "")
    joined = F.translate(bare, "-", "")
    s = F.when(joined.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), joined).otherwise(F.translate(bare, "-_", "+/"))
    kind = (
        F.when(s.rlike("^[0-9]*$"), 10)
        .when(s.rlike("^([0-9a-f]*|[0-9A-F]*)$"), 16)
        .when(s.rlike("^([a-z]*|[A-Z]*)$"), 26)
        .when(s.rlike("^([A-Z2-7]*|[a-z2-7]*)$"), 32)
        .when(s.rlike("^([0-9a-z]*|[0-9A-Z]*)$"), 36)
        .when(s.rlike("^[A-Za-z]*$"), 52)
        .when(s.rlike("^[1-9A-HJ-NP-Za-km-z]*$"), 58)
        .when(s.rlike("^[0-9A-Za-z]*$"), 62)
        .otherwise(64)
    )
    order = F.lit(ALPHABETS[64])
    for size, letters in ALPHABETS.items():
        order = F.when(F.col("_alphabet") == size, F.lit(letters)).otherwise(order)
    coded = (
        F.when(F.col("_alphabet").isin(16, 26, 36), F.lower("_s"))
        .when(F.col("_alphabet") == 32, F.upper("_s"))
        .otherwise(F.col("_s"))
    )
    some = candidates.withColumns({"_s": s, "_alphabet": kind}).filter(F.char_length("_s") > 1)
    df = some.withColumns(
        {
            "_n": F.char_length("_s").cast("double"),
            "_code": F.transform(
                F.filter(F.split(coded, ""), lambda c: c != ""), lambda c: F.instr(order, c) - 1
            ),
        }
    )
    a, n, code = F.col("_alphabet"), F.col("_n"), F.col("_code")
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda x, y: x + y.cast("double"))
    counts = F.transform(
        F.array_distinct(code), lambda d: F.size(F.filter(code, lambda c: c == d)).cast("double")
    )
    df = df.withColumns(
        {
            "_chi": a / n * total(F.transform(counts, lambda c: c * c)) - n,
            "_high": F.transform(code, lambda c: (c >= a / 2).cast("int")),
            "_class": F.transform(
                F.filter(F.split("_s", ""), lambda c: c != ""),
                lambda c: F.when(c.rlike("[a-z]"), 0).when(c.rlike("[A-Z]"), 1).otherwise(2),
            ),
            "_mean": total(code) / n,
        }
    )
    steps = lambda xs: F.zip_with(
        F.slice(xs, 1, F.size(xs) - 1), F.slice(xs, 2, F.size(xs) - 1), lambda x, y: (x != y).cast("double")
    )
    mean = F.col("_mean")
    products = F.zip_with(
        F.slice(code, 1, F.size(code) - 1),
        F.slice(code, 2, F.size(code) - 1),
        lambda x, y: (x - mean) * (y - mean),
    )
    df = df.withColumns(
        {
            "_ups": total(F.col("_high")),
            "_runs": total(steps(F.col("_high"))) + 1,
            "_turns": total(steps(F.col("_class"))),
            "_serial": total(products)
            / F.nullif(total(F.transform(code, lambda c: (c - mean) * (c - mean))), F.lit(0.0)),
        }
    )
    d = a - 1
    cube = F.pow(F.greatest(F.col("_chi"), F.lit(0.0)) / d, F.lit(1 / 3))
    uniform = 1 - _phi((cube - (1 - 2 / (9 * d))) / F.sqrt(2 / (9 * d)))
    ups = F.col("_ups")
    downs = n - ups
    expected = 2 * ups * downs / n + 1
    spread = (expected - 1) * (expected - 2) / F.greatest(n - 1, F.lit(1.0))
    runs = 2 * (1 - _phi(F.abs(F.col("_runs") - expected) / F.sqrt(F.nullif(spread, F.lit(0.0)))))
    serial = 2 * (1 - _phi(F.abs(F.col("_serial")) * F.sqrt(n)))
    excess = (n - 1) * (F.greatest(a * COINCIDENCE, F.lit(1.5)) - 1)
    flat = _phi((F.col("_chi") - (d + excess)) / F.sqrt(2 * d + 4 * excess))
    usual = (n - 1) * CHANGES
    mixed = 1 - _phi((F.col("_turns") - 0.5 - usual) / F.sqrt(usual * (1 - CHANGES)))
    log = F.log(F.greatest(flat, F.lit(1e-15))) + F.log(F.greatest(mixed, F.lit(1e-15)))
    return df.withColumns(
        {
            "_uniform": uniform,
            "_runs_p": F.coalesce(runs, F.lit(0.0)),
            "_serial_p": F.coalesce(serial, F.lit(0.0)),
            "_p": F.exp(log) * (1 - log),
        }
    ).drop("_s", "_n", "_code", "_chi", "_high", "_class", "_mean", "_ups", "_runs", "_turns", "_serial")


def discoveries(tested: DataFrame) -> DataFrame:
    """The rows of ``tested`` (with ``_p``, ``_length`` and the test results) that are found random.

    Benjamini-Hochberg by length band. P-values are binned by their logarithm, rounded to
    the larger side, and counts by band and bin decide: their number is fixed.
    """
    band = sum((F.col("_length") >= at).cast("int") for at in BANDS)
    depth = F.floor(-F.log10(F.greatest(F.col("_p"), F.lit(1e-30))) * BINS).cast("int")
    random = (F.col("_uniform") >= VETO) & (F.col("_runs_p") >= VETO) & (F.col("_serial_p") >= VETO)
    binned = tested.withColumns(
        {"_band": band, "_bin": F.when(random, F.least(depth, F.lit(DEEPEST))).otherwise(0)}
    )
    counts = binned.groupBy("_band", "_bin").agg(F.count(F.lit(1)).alias("rows"))
    over = Window.partitionBy("_band")
    passed = counts.withColumns(
        {"deeper": F.sum("rows").over(over.orderBy(F.desc("_bin"))), "all": F.sum("rows").over(over)}
    ).filter(F.pow(F.lit(10.0), -F.col("_bin") / BINS) <= FALSE_SHARE * F.col("deeper") / F.col("all"))
    # A row per band, of which there are len(BANDS) + 1.
    least = F.broadcast(passed.groupBy("_band").agg(F.min("_bin").alias("_least")))
    return binned.join(least, "_band").filter(F.col("_bin") >= F.col("_least"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row; a span has start, place of its kind, end, kind.

    Spans count code points, end exclusive, and are sorted. Null counts as empty; rows
    without secrets have an empty list. Base spans of different kinds may overlap; a
    random span overlaps none of them. Repeated rows are scanned each; other columns are
    not read. An empty table gives an empty result. Texts of any length are read whole.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            *(
                _pieces(text, pattern).alias(kind)
                for kind, pattern in zip(KINDS, (ASSIGN, ACCESS, HEX, CANDIDATE))
            ),
        ),
        "secret-pieces",
    )
    spans = None
    for place, kind in enumerate(KINDS):
        one = rows.filter(F.size(kind) > 0).select(
            "row", F.lit(place).alias("place"), F.posexplode(kind).alias("at", "piece")
        )
        spans = one if spans is None else spans.unionByName(one)
    ends = F.sum("piece.reach").over(Window.partitionBy("row", "place").orderBy("at"))
    spans = spans.withColumn("end", ends).select(
        "row",
        "place",
        (F.col("end") - F.char_length("piece.match")).cast("int").alias("start"),
        F.col("end").cast("int").alias("end"),
        F.col("piece.match").alias("match"),
    )
    value = F.regexp_extract("match", ASSIGN, 1)
    spans = spans.filter((F.col("place") > 0) | (F.char_length(value) >= ASSIGN_LEAST))
    base = F.col("place") < len(KINDS) - 1
    here = Window.partitionBy("row").orderBy("start")
    reached = F.max(F.when(base, F.col("end"))).over(here)
    following = F.min(F.when(base, F.col("start"))).over(
        here.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    )
    spans = stored(
        spans.withColumns({"reached": reached, "following": following})
        .filter(
            base
            | (
                (F.coalesce("reached", F.lit(0)) <= F.col("start"))
                & (F.coalesce("following", F.lit(2**31 - 1)) >= F.col("end"))
            )
        )
        .select("row", "place", "start", "end", "match"),
        "secret-spans",
    )
    tested = battery(spans.filter(~base)).withColumn("_length", F.col("end") - F.col("start"))
    tested = stored(tested.drop("match"), "secret-tests")
    columns = ["row", "place", "start", "end"]
    listed = spans.filter(base).select(*columns).unionByName(discoveries(tested).select(*columns))
    names = F.array(*map(F.lit, KINDS))
    listed = listed.groupBy("row").agg(
        F.sort_array(
            F.collect_list(
                F.struct("start", "place", "end", F.element_at(names, F.col("place") + 1).alias("kind"))
            )
        ).alias("spans")
    )
    none = F.expr("cast(array() as array<struct<start:int,place:int,end:int,kind:string>>)")
    return rows.select("row", "id").join(listed, "row", "left").select(
        "id", F.coalesce("spans", none).alias("spans")
    )
