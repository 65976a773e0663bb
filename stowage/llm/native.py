"""Column expressions shared by operators that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stowage.llm.words import BLANKS

# The characters between words.
BLANK_CHARS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def trimmed(text: str | Column) -> Column:
    return F.btrim(text, F.lit(BLANK_CHARS))


def words_of(text: Column) -> Column:
    """The words of a text; an empty array for a null or blank one."""
    return let(
        trimmed(F.coalesce(text, F.lit(""))),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANKS, -1)),
    )


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")
