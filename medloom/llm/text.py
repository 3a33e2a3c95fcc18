"""Words and keys of texts, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Separators between words: ASCII white space, and whatever is neither a lower-case letter, a digit nor beyond ASCII.
SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same where upper-case letters still stand.
NOT_CASED_ALNUM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.array_remove(F.split(text, SPACE), "")


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def alnum_words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and characters beyond ASCII."""
    return F.array_remove(F.split(lowered(text), NOT_ALNUM), "")


def cased_words(text: Column) -> Column:
    """The words of ``alnum_words`` as they stand in the text. To lower-case words is quicker than a whole text."""
    return F.array_remove(F.split(text, NOT_CASED_ALNUM), "")


def lowered_word(word: Column) -> Column:
    """``lowered``, by a quicker way where the word is all ASCII."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(lowered(word))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
