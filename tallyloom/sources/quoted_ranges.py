"""Delimited files with line breaks inside quotes, read by many tasks per file.

A byte range of a file does not show whether it begins inside quotes.  Two passes find out:

1. Every range counts its quotes.  A range begins inside quotes when the ranges before it in the file
   hold an odd number.  One row per range meets here, nothing else.
2. Every range joins its lines to records, starting at the first true end of a record.  The piece of
   a record before that, and the piece left open at the range's end, are parts; parts of a file are
   put together in order, at most two per range.  If no range begins inside quotes there are none.

Ranges are those of Spark's own text scan, so any store that Spark reads will do, and both passes see
the same ones.  Lines end with a line feed, or a carriage return and a line feed; breaks inside quotes
stay as they are.  Values are parsed in the JVM from whole records.

Counting quotes tells inside from outside only where quotes stand at the borders of values.  A record
with a quote anywhere else is an error, never a wrong row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyloom.session import durable

_RECORD, _ENDS, _PASSES, _OPENS = 0, 1, 2, 3  # a record; a part that ends one, lies within one, begins one
_PARTS = "file long, begin long, name string, kind int, first boolean, text string"
#: A range's number of bytes is set by ``spark.sql.files.maxPartitionBytes``; an encoding must hold ASCII as it is.
_WIDE = ("utf-16", "utf_16", "utf16", "utf-32", "utf_32", "utf32")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, begin, name, value``: raw lines with the range they are in, in order inside a task."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"),
        F.col("_metadata.file_name").alias("name"), F.col("value").cast("binary").alias("value"),
    )


def range_states(lines: DataFrame) -> DataFrame:
    """``file, begin, inside, open``: whether each range begins, and ends, inside quotes."""
    quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value").cast("string"), F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "begin").agg(F.sum(quotes).alias("quotes"))
    so_far = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("quotes").over(so_far)
    return counted.select("file", "begin", ((total - F.col("quotes")) % 2 == 1).alias("inside"), (total % 2 == 1).alias("open"))


class _Joiner:
    """Joins the lines of one range to records and parts of records."""

    def __init__(self, inside: bool, first_range: bool, encoding: str) -> None:
        self.inside, self.headed, self.encoding = inside, inside, encoding
        self.lines: list[bytes] = []
        self.first = first_range

    def _text(self) -> str:
        text = b"\n".join(self.lines)
        self.lines = []
        return text.decode(self.encoding)

    def add(self, line: bytes) -> tuple[int, bool, str] | None:
        self.lines.append(line)
        if line.count(b'"') % 2:
            self.inside = not self.inside
        if self.inside:
            return None
        if self.headed:
            self.headed = False
            return _ENDS, False, self._text()
        text = self._text()
        if text in ("", "\r"):
            return None
        first, self.first = self.first, False
        return _RECORD, first, text

    def rest(self) -> tuple[int, bool, str] | None:
        """What is left open where the range ends."""
        if not self.lines:
            return None
        return (_PASSES if self.headed else _OPENS), self.first and not self.headed, self._text()


def _joined(lines: DataFrame, encoding: str) -> DataFrame:
    """Records and parts of ``lines`` with their range's ``inside``."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.string())
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "begin", "name", "kind", "first", "text"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, joiner, name = None, None, ""
        for batch in batches:
            file, begin, names, inside = (batch.column(c).to_pylist() for c in ("file", "begin", "name", "inside"))
            rows: list[tuple] = []
            for i, line in enumerate(batch.column("value").to_pylist()):
                if (file[i], begin[i]) != at:
                    if joiner is not None and (part := joiner.rest()):
                        rows.append((*at, name, *part))
                    at, name = (file[i], begin[i]), names[i]
                    if inside[i] is None:
                        raise ValueError(f"the ranges of {name} have changed since their quotes were counted")
                    joiner = _Joiner(bool(inside[i]), begin[i] == 0, encoding)
                if part := joiner.add(line):
                    rows.append((*at, name, *part))
            yield batch_of(rows)
        if joiner is not None and (part := joiner.rest()):
            yield batch_of([(*at, name, *part)])

    return lines.select("file", "begin", "name", "inside", "value").mapInArrow(join, _PARTS)


def _whole(parts: DataFrame) -> DataFrame:
    """Records from their parts, which follow each other in the file: one that begins, then the rest."""
    opens = (F.col("kind") == _OPENS).cast("int")
    order = Window.partitionBy("file").orderBy("begin", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parts.withColumn("record", F.sum(opens).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("begin", "kind", "text")))
    return numbered.groupBy("file", "record").agg(
        F.first("name").alias("name"), F.bool_or("first").alias("first"), pieces.alias("pieces"), F.count_if(F.col("kind") == _ENDS).alias("ends"),
    ).select("name", "first", F.when(F.col("ends") == 1, F.array_join(F.transform("pieces", lambda p: p["text"]), "\n")).otherwise(
        F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("name")))
    ).alias("text"))


def _well_formed(text: Column, sep: str) -> Column:
    """Whether quotes stand only at the borders of values, or doubled inside quoted ones."""
    s = re.escape(sep)
    value = rf'(?:"[^"]*+(?:""[^"]*+)*+"|[^"{s}]*+)'
    return ~F.contains(text, F.lit('"')) | text.rlike(rf"\A{value}(?:{s}{value})*+\z")


def read_quoted_text(
    spark: SparkSession, path: str | list[str], columns: list[str], sep: str = ";", encoding: str = "ISO-8859-1", origin: str | None = None
) -> DataFrame:
    """All-string rows of files that share one header; every range of a file is a task of its own.

    ``columns`` is the header as it stands in the files; a file with another header, a record with more
    or fewer values, a quote inside an unquoted value, and a quote that is never closed fail the read.
    Empty lines between records are skipped.  The rows must be read under the same settings for the size of
    ranges as this call; a range that was not counted is an error.  With ``origin``, a column of that name holds the
    file's name.
    """
    if encoding.lower().startswith(_WIDE):
        raise ValueError(f"{encoding} does not hold ASCII characters as single bytes")
    if len(sep) != 1:
        raise ValueError("the separator must be one character")
    lines = _lines(spark, path)
    # One row of a few bytes per range, so it is broadcast; lines keep their order.
    states = durable(range_states(lines), "range-states")
    joined = _joined(lines.join(F.broadcast(states.drop("open")), ["file", "begin"], "left"), encoding)
    records = joined.where(F.col("kind") == _RECORD).select("name", "first", "text")
    if not states.where("open").isEmpty():
        records = records.unionByName(_whole(joined.where(F.col("kind") != _RECORD)))
    text = F.regexp_replace("text", r"\r\z", "")
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    options = {
        "sep": sep, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\u0000", "mode": "FAILFAST", "multiLine": "true",
        "columnPruning": "false", "maxCharsPerColumn": "-1", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    checked = F.when(_well_formed(F.col("text"), sep), F.col("text")).otherwise(
        F.raise_error(F.concat(F.lit("quotes inside a value, or not closed, in "), F.col("name")))
    )
    parsed = records.select("name", "first", text.alias("text")).select(
        "name", "first", F.from_csv(checked, schema, options).alias("v")
    )
    names = F.array(*(F.trim(F.col(f"v.c{i}")) for i in range(len(columns))))
    other = F.raise_error(F.concat(F.lit("another header in "), F.col("name"))).cast("boolean")
    header = F.when(names == F.array(*(F.lit(c.strip()) for c in columns)), False).otherwise(other)
    rows = parsed.where(F.when(F.col("first"), header).otherwise(True))
    named = [F.col(f"v.c{i}").alias(name) for i, name in enumerate(columns)]
    return rows.select(*named, *([F.col("name").alias(origin)] if origin else []))
