"""Rendering of rows as separated text, and reading such text back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEPARATOR = ";"


def render_line(*fields: Column, separator: str = SEPARATOR) -> Column:
    """Join fields; a missing field stays an empty one, so positions never shift.

    Pass decimals, not doubles: doubles switch to exponent form when large.
    """
    return F.concat_ws(separator, *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])


def without_separator(col: Column, separator: str = SEPARATOR, instead: str = ",") -> Column:
    """A name that cannot break a rendered line."""
    return F.replace(col, F.lit(separator), F.lit(instead))


def line_field(line: Column, position: int, separator: str = SEPARATOR) -> Column:
    """Zero-based field of a rendered line; NULL when the line is shorter."""
    return F.try_element_at(F.split(line, separator, -1), F.lit(position + 1))


def iso_day(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def iso_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")
