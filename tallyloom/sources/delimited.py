"""Delimited text, loose or zipped, as all-string DataFrames."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyloom.sources.quoted_ranges import read_quoted_text
from tallyloom.sources.zipped_source import ZippedCsvSource, register_zipped_csv

ORIGIN_COLUMN = "_arquivo_origem"
_BATCH_ROWS = 10_000


def string_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_delimited_text(
    spark: SparkSession, path: str | list[str], sep: str = ";", encoding: str = "ISO-8859-1",
    origin: bool = True, multi_line: bool = True, by_ranges: bool = True,
) -> DataFrame:
    """All-string scan of delimited files with a header; no value is read as NULL.

    A line with more or fewer values than the header fails the read.  Quoted fields may hold line
    breaks; a file is still read by many tasks, see :mod:`tallyloom.sources.quoted_ranges`.  Files with
    quotes inside unquoted values need ``by_ranges=False``, which makes each file one task; pass
    ``multi_line=False`` for files known to have no quoted breaks.

    The header is taken from the files; names are trimmed.  Files with other columns belong in a
    call of their own, joined by :func:`union_parts`.
    """
    # Without pruning every line is checked in full, whatever columns are used later.
    reader = spark.read.option("columnPruning", "false")
    df = reader.csv(
        path, sep=sep, encoding=encoding, header=True, inferSchema=False, enforceSchema=False,
        quote='"', escape='"', multiLine=multi_line, emptyValue="", nullValue="\u0000", mode="FAILFAST",
    )
    if multi_line and by_ranges:
        names = [name.strip() for name in df.columns]
        return read_quoted_text(spark, path, names, sep, encoding, ORIGIN_COLUMN if origin else None).fillna("")
    file_name = F.col("_metadata.file_name").alias(ORIGIN_COLUMN)
    columns = [F.col(f"`{name}`").alias(name.strip()) for name in df.columns]
    filled = df.select(*columns, *([file_name] if origin else []))
    return filled.fillna("")


def _members(path: str, content: bytes, sep: str, encoding: str) -> Iterator[tuple[str, list[str], Iterator[list[str]]]]:
    """Name, header and further records of each CSV member."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        members = [m for m in archive.namelist() if m.lower().endswith(".csv")]
        if not members:
            raise ValueError(f"no CSV member in {path}")
        for member in members:
            with archive.open(member) as raw:
                reader = csv.reader(io.TextIOWrapper(raw, encoding=encoding, newline=""), delimiter=sep)
                yield member, [name.strip() for name in next(reader, [])], reader


def member_columns(archives: DataFrame, sep: str = ";", encoding: str = "latin-1") -> list[str]:
    """All column names of all members, in code-point order; reads the headers only."""

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                names = {n for _, header, _ in _members(path, content, sep, encoding) for n in header}
                yield pd.DataFrame({"name": sorted(names)})

    found = archives.select("path", "content").mapInPandas(headers, "name string").distinct()
    return sorted(row["name"] for row in found.collect())


def rows_of_archives(
    archives: DataFrame, columns: Sequence[str] | None = None, sep: str = ";", encoding: str = "latin-1"
) -> DataFrame:
    """CSV members of zip archives as all-string rows, with the member name.

    ``archives`` has ``path`` and ``content``.  Without ``columns`` a first pass over the headers
    finds all of them.  One archive is one row and streams through its task member by member;
    members that are not CSV are skipped, an archive without any is an error.  Columns absent from a
    member are empty.  A member with a column that is not listed is an error, and so is a row with
    more or fewer values than its header.
    """
    names = list(columns) if columns is not None else member_columns(archives, sep, encoding)
    schema = string_schema([*names, ORIGIN_COLUMN])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for member, header, reader in _members(path, content, sep, encoding):
                    yield from _frames(reader, header, names, member)

    return archives.select("path", "content").mapInPandas(parse, schema)


def _frames(reader: Iterator[list[str]], header: list[str], names: list[str], member: str) -> Iterator[pd.DataFrame]:
    if unknown := sorted(set(header) - set(names)):
        raise ValueError(f"{member} has columns that are not listed: {unknown}")
    places = [header.index(name) if name in header else None for name in names]
    rows: list[list[str]] = []
    for number, record in enumerate(reader, 1):
        if not record:
            continue
        if len(record) != len(header):
            raise ValueError(f"record {number} of {member} has {len(record)} values, its header {len(header)}")
        rows.append([record[i] if i is not None else "" for i in places] + [member])
        if len(rows) == _BATCH_ROWS:
            yield pd.DataFrame(rows, columns=[*names, ORIGIN_COLUMN])
            rows = []
    if rows:
        yield pd.DataFrame(rows, columns=[*names, ORIGIN_COLUMN])


def read_zipped_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ";", encoding: str = "latin-1",
    by_member: bool = True,
) -> DataFrame:
    """CSV members of every zip archive under ``path``, one task per member.

    Rows are as in :func:`rows_of_archives`.  The archives must lie on a mounted folder or in a store that
    Arrow opens; ``by_member=False`` reads archives of any store that Spark reads, each in one task and
    whole in memory.
    """
    if not by_member:
        return rows_of_archives(spark.read.format("binaryFile").load(path), columns, sep, encoding)
    register_zipped_csv(spark)
    reader = spark.read.format(ZippedCsvSource.name()).option("sep", sep).option("encoding", encoding).option("origin", ORIGIN_COLUMN)
    if columns is not None:
        reader = reader.option("columns", "\n".join(columns)).option("strict", "true")
    return reader.load(path)


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column absent from a part is empty there."""
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return combined.fillna("")


def tagged(df: DataFrame, column: str, value: str) -> DataFrame:
    """Mark every row of a part with a constant."""
    return df.withColumn(column, F.lit(value))
