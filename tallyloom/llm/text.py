"""Text expressions that several operators share; all of them run in the JVM."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

# What separates words, and what counts as white space.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACES = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty text.

    ``lower`` is several times faster than ``translate`` and the same for a text whose other
    characters have no lower case of their own.
    """
    text = F.coalesce(text, F.lit(""))
    other = text.rlike(r"[^\x00-\x7F\u00DF-\u00F6\u00F8-\u00FF]")
    return F.when(other, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def ascii_words(text: Column) -> Column:
    """Words of letters, digits and anything outside ASCII, with A-Z in lower case."""
    return F.array_remove(F.split(ascii_lower(text), WORD_BREAK), "")


def ascii_word_count(text: Column) -> Column:
    """Number of those words; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    return F.size(F.array_remove(parts, "")).cast("long")


def one_space(text: Column) -> Column:
    """Each run of white space as one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def word_count(text: Column) -> Column:
    """Number of runs of anything but white space; null has none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.translate(bare, " \t\n\x0b\x0c\r", "")).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until the table has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_name(id_: Column, text_hash: Column) -> Column:
    """A document's id and text hash as one value that is never null."""
    return F.concat_ws("-", F.coalesce(id_.cast("long").cast("string"), F.lit("none")), text_hash)
