"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, _kept string, "
    "_mix_size string, _radix_n string, ids string, id string, key string, row string, n string"
)


def prose(seed: int, words: int = 120) -> str:
    rng = random.Random(seed)
    parts = ["on", "the", "ther", "and", "re", "es", "tion", "ed", "in", "ha", "ou", "ai"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words))


def awkward() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars)."""
    base = prose(1)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "a", 1),
        (2, base, None, "a", None),  # copy
        (3, " ".join(near), "en", "b", 3),  # near copy
        (4, None, "en", "b", None),
        (5, "", "en", None, 0),
        (6, "", None, "c", 0),
        (7, "two words", "en", "c", 9),
        (7, "two words", "en", "c", 9),  # repeated row
        (7, prose(2), "en", "c", 5),  # another text under a repeated id
        (None, prose(3), "en", "a", 1),
        (None, None, None, None, None),
        (9, prose(4, 6000), "en", "a", 1),  # long
        (10, "x" * 40_000, "xx", "b", 1),  # one long word
        (11, "  \t\n ", "xx", "b", 1),
        (12, prose(5, 40) + " " + prose(1, 60), "en", "b", 1),  # shares a passage with 1
        (-13, "Été à la plage 😀 " + prose(6, 30), "fr", "é", 1),
    ]
    return rows


def table(spark, rows=None, schema=SCHEMA):
    rows = awkward() if rows is None else rows
    width = schema.count(",") + 1
    return spark.createDataFrame([(*r, *["z"] * (width - len(r))) for r in rows], schema)
