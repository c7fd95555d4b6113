"""Column helpers over texts that stay in built-in SQL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words are runs of anything but space, tab, LF, VT, FF and CR.
WORD, BLANK = r"[^\x20\x09-\x0D]+", " \t\n\x0B\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column | str) -> Column:
    """The text as a string; null is the empty text."""
    return F.coalesce(F.col(text).cast("string") if isinstance(text, str) else text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def has_word(text: Column | str) -> Column:
    """Whether a text has a word: ``rlike`` WORD without a Java string of every text."""
    return F.ltrim(text, F.lit(BLANK)) != ""


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")
