"""String helpers: Column in, Column out, all inside code generation."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in Unicode text processing; SQL trim
# alone would remove spaces only.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def text(c: Column | str, default: str = "") -> Column:
    """A missing value reads as ``default``; an empty one stays empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def nonempty(c: Column) -> Column:
    """NULL in place of an empty string, for use in ``coalesce``."""
    return F.nullif(c, F.lit(""))


def first_line(c: Column) -> Column:
    return F.substring_index(c, "\n", 1)


def cut(c: Column, chars: int) -> Column:
    return F.left(c, F.lit(chars))


def contains_any(c: Column, words: Iterable[str]) -> Column:
    """True where ``c`` holds at least one of the words (case-sensitive)."""
    tests = [c.contains(F.lit(w)) for w in words]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def before_marker(c: Column, marker: str | None) -> Column:
    """The part before the first ``marker``; NULL where the marker is not in ``c``."""
    if not marker:
        return F.lit(None).cast("string")
    return F.when(c.contains(F.lit(marker)), F.substring_index(c, marker, 1))


def first_int(c: Column, pattern: str) -> Column:
    """The integer in group 1 of the first match, else 0."""
    return F.coalesce(F.regexp_extract(c, pattern, 1).try_cast("int"), F.lit(0))


def fill(template: str, **values: Column) -> Column:
    """``{name}`` slots of a template replaced by columns; other braces stay as they are."""
    pieces = re.split(r"\{(" + "|".join(values) + r")\}", template)
    parts = [
        values[piece].cast("string") if i % 2 else F.lit(piece)
        for i, piece in enumerate(pieces)
        if i % 2 or piece
    ]
    return F.concat(*parts) if parts else F.lit("")
