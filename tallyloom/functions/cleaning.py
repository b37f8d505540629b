"""Cleaning of free text, numbers and dates, as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------------------
NULL_SENTINELS = ("", "#NULO#", "#NULO", "#NE#", "#NE")
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy")
FIRST_NUMBER_PATTERN = r"([0-9]+([.][0-9]+)?)"
MARKUP_PATTERNS = (
    r"(?i)<?ref[ \t]+name[ \t]*=.*$",
    r"(?i)<ref[^>]*>.*$",
    r"<[^>]*>",
    r"\[[^\]]*\]",
)
MARKUP_SIGNS = r"[=<\[]|  "
NAME_KEY_PUNCTUATION = "[^A-Za-z0-9À-ÿ]"
ACCENTED = "ÁÀÂÃÉÊÍÓÔÕÚÇáàâãéêíóôõúç"
UNACCENTED = "AAAAEEIOOOUCaaaaeeiooouc"
CONFIDENCE_PATTERNS = (
    r"confian[cç]a[^0-9]{0,40}([0-9]{2})([,.][0-9]+)? ?%",
    r"([0-9]{2})([,.][0-9]+)? ?%[^.]{0,40}confian",
)
# ----------------------------------------------------------------------------------------


def null_sentinels(col: Column, sentinels: Sequence[str] = NULL_SENTINELS) -> Column:
    """Trim, turn the source's "no value" marks into NULL, collapse runs of spaces."""
    trimmed = F.trim(col)
    return F.when(~trimmed.isin(*sentinels), F.regexp_replace(trimmed, " +", " "))


def _text(col: Column, cleaned: bool) -> Column:
    return col if cleaned else null_sentinels(col)


def locale_decimal(col: Column, dtype: str = "decimal(18,2)", cleaned: bool = False) -> Column:
    """``"96.380,00"`` to a number; every dot is a grouping mark, negative codes are NULL.

    Here and below, ``cleaned`` says that the column already went through ``null_sentinels``.
    """
    plain = F.translate(_text(col, cleaned), ",.", ".")
    value = plain.try_cast(dtype)
    return F.when(value >= 0, value)


def positive_int(col: Column, allow_fraction: bool = False, cleaned: bool = False) -> Column:
    """Whole number above zero, else NULL.

    Text with a decimal part (``"2000,00"``) is NULL unless ``allow_fraction`` is set.
    """
    if allow_fraction:
        value = locale_decimal(col, "decimal(18,2)", cleaned).try_cast("int")
    else:
        value = locale_decimal(col, "int", cleaned)
    return F.when(value > 0, value)


def _has_shape_of(text: Column, fmt: str) -> Column:
    """The text has the same kinds of separators as the format.

    A text that fails here cannot parse, and a failed parse costs far more than this test.
    """
    tests = [text.contains(mark) if mark in fmt else ~text.contains(mark) for mark in "-/: "]
    return tests[0] & tests[1] & tests[2] & tests[3]


def multi_format_timestamp(
    col: Column, formats: Sequence[str] = TIMESTAMP_FORMATS, cleaned: bool = False
) -> Column:
    """The first format that parses wins."""
    text = _text(col, cleaned)
    return F.coalesce(*[
        F.when(_has_shape_of(text, fmt), F.try_to_timestamp(text, F.lit(fmt))) for fmt in formats
    ])


def first_number(col: Column, dtype: str = "decimal(9,2)") -> Column:
    """First number inside free text: ``"± 2,0 p.p."`` is 2.0, ``"<1"`` is 1."""
    dotted = F.replace(col.cast("string"), F.lit(","), F.lit("."))
    found = F.regexp_extract(dotted, FIRST_NUMBER_PATTERN, 1)
    return F.nullif(found, F.lit("")).try_cast(dtype)


def strip_markup(col: Column) -> Column:
    """Drop citations, tags and bracketed notes, then collapse spaces.

    Most cells hold none of these, which one look at the text tells.
    """
    text = stripped = col.cast("string")
    for pattern in MARKUP_PATTERNS:
        stripped = F.regexp_replace(stripped, pattern, "")
    stripped = F.regexp_replace(stripped, " +", " ")
    return F.trim(F.when(text.rlike(MARKUP_SIGNS), stripped).otherwise(text))


def name_key(col: Column) -> Column:
    """Words in lower case and byte order, joined by a bar; accents are kept."""
    spaced = F.lower(F.regexp_replace(col.cast("string"), NAME_KEY_PUNCTUATION + "+", " "))
    return F.array_join(F.sort_array(F.split(F.trim(spaced), " ")), "|")


def fold_key(col: Column) -> Column:
    """Accents folded, lower case, letters and digits only."""
    folded = F.lower(F.translate(col, ACCENTED, UNACCENTED))
    return F.regexp_replace(folded, "[^a-z0-9]", "")


def digits_only(col: Column, dtype: str | None = None) -> Column:
    digits = F.regexp_replace(col, "[^0-9]", "")
    return digits if dtype is None else digits.try_cast(dtype)


def title_from_column_name(col: Column, suffix: str) -> Column:
    """``JANE_DOE_SHARE`` with suffix ``_SHARE`` becomes ``Jane Doe``."""
    stem = F.regexp_replace(col, suffix + "$", "")
    return F.initcap(F.replace(stem, F.lit("_"), F.lit(" ")))


def fraction_to_percent(col: Column, dtype: str = "decimal(9,4)") -> Column:
    return (col * 100).cast(dtype)


def confidence_level(col: Column, patterns: Sequence[str] = CONFIDENCE_PATTERNS) -> Column:
    """Two-digit confidence level out of free text; patterns are tried in order."""
    hits = [F.nullif(F.regexp_extract(col, pattern, 1), F.lit("")) for pattern in patterns]
    return F.coalesce(*hits).cast("int")


def search_text(*cols: Column) -> Column:
    """Several text columns as one lower-case text; missing parts are skipped."""
    return F.lower(F.concat_ws(" ", *cols))


def display_name(trade_name: Column, legal_name: Column) -> Column:
    """Trade name, or the legal name in title case when there is none."""
    return F.coalesce(trade_name, F.initcap(legal_name))
