"""What counts as a word, and small helpers on text columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words, and a word.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def word_array(text: Column) -> Column:
    """The words in order, empty for null."""
    parts = F.split(F.coalesce(text, F.lit("")), f"{SPACE}+")
    return F.filter(parts, lambda part: part != "")


def chance(seed: int, key: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the key, a string, alone."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(2.0**52)
