"""Small helpers that the other column functions share."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(c: Column) -> Column:
    """The trimmed string, or null if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def first_filled(*cols: Column) -> Column:
    """The first of the strings that is not null and not blank, trimmed; else null."""
    return F.coalesce(*[filled(c) for c in cols])


def strip(c: Column) -> Column:
    """Without Unicode white space at either end (Spark's own trim takes blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def collapse(c: Column) -> Column:
    """Runs of Unicode white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_tags(c: Column) -> Column:
    """Every <tag> as one blank."""
    return F.regexp_replace(c, r"<[^>]+>", " ")


def has_any(c: Column, words) -> Column:
    """Whether one of the words occurs anywhere in the text (null counts as empty)."""
    return F.coalesce(c, F.lit("")).rlike("|".join(quoted(w) for w in words))


def has_word(c: Column, word: str) -> Column:
    """Whether the word occurs between word borders."""
    return F.coalesce(c, F.lit("")).rlike(rf"(?U)\b{quoted(word)}\b")


def quoted(word: str) -> str:
    """The word as a pattern that Java and RE2 read alike."""
    return re.sub(r"([^\w\s-])", r"\\\1", word)
