"""A data source of CSV members in zip archives, one task per member.

    register_zipped_csv(spark)
    spark.read.format("zipped_csv").option("sep", ";").load("/folder or archive")

Reading is planned from each archive's central directory, which lists its members at its end; a task
then opens its own member by seeking to it.  No archive is ever read whole, in memory or by one task.
Archives are found and opened through Arrow's file systems, so besides mounted folders any store with
such a file system will do, given as a URI.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

BATCH_ROWS = 10_000


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and "://" not in path else path)
    return fs.LocalFileSystem(), path


def archives_under(path: str) -> list[str]:
    """A zip archive itself, or the archives of a folder and the folders in it, by path."""
    store, place = _located(path)
    info = store.get_file_info(place)
    if info.type == fs.FileType.File:
        return [path]
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    found = [i.path for i in store.get_file_info(fs.FileSelector(place, recursive=True)) if i.is_file and i.path.lower().endswith(".zip")]
    return sorted(path.rstrip("/") + p[len(place.rstrip("/")) :] for p in found)


def _opened(archive: str) -> zipfile.ZipFile:
    store, place = _located(archive)
    return zipfile.ZipFile(store.open_input_file(place))


def members_of(archive: str) -> list[str]:
    with _opened(archive) as opened:
        members = [m for m in opened.namelist() if m.lower().endswith(".csv")]
    if not members:
        raise ValueError(f"no CSV member in {archive}")
    return members


@dataclass
class Member(InputPartition):
    archive: str
    member: str


class ZippedCsvSource(DataSource):
    """All-string rows of the CSV members of zip archives, with the member's name.

    Options: ``sep`` (``;``), ``encoding`` (``latin-1``), ``origin`` (the member column's name,
    ``_arquivo_origem``; empty for none) and ``columns``, names separated by line feeds, of which only
    those become rows; with ``strict`` a member that has others fails the read.  Without ``columns``, or a
    schema, the columns are all those of all members.  A column that a member lacks is empty; a record with
    more or fewer values than its header fails the read, and so does an archive without members.  Filters
    on the member column drop whole tasks.
    """

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def _option(self, name: str, default: str) -> str:
        return self.options.get(name, default)

    @property
    def _origin(self) -> str:
        return self._option("origin", "_arquivo_origem")

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError("the zipped_csv source needs a path")
        return path

    def schema(self) -> StructType:
        if "columns" in self.options:
            names = [n for n in self.options["columns"].split("\n") if n]
        else:
            found: set[str] = set()
            for archive in archives_under(self._path()):
                for member in members_of(archive):
                    found.update(header_of(archive, member, self._option("sep", ";"), self._option("encoding", "latin-1")))
            names = sorted(found)
        return StructType([StructField(n, StringType()) for n in [*names, *([self._origin] if self._origin else [])]])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self._path(), schema.fieldNames(), self._option("sep", ";"), self._option("encoding", "latin-1"), self._origin,
                       self._option("strict", "false").lower() == "true")


def _records(archive: str, member: str, sep: str, encoding: str) -> Iterator[list[str]]:
    with _opened(archive) as opened, opened.open(member) as raw:
        yield from csv.reader(io.TextIOWrapper(raw, encoding=encoding, newline=""), delimiter=sep)


def header_of(archive: str, member: str, sep: str, encoding: str) -> list[str]:
    return [name.strip() for name in next(_records(archive, member, sep, encoding), [])]


class _Reader(DataSourceReader):
    def __init__(self, path: str, names: list[str], sep: str, encoding: str, origin: str, strict: bool) -> None:
        self.path, self.names, self.sep, self.encoding, self.origin, self.strict = path, names, sep, encoding, origin, strict
        self.members: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality on the member column chooses tasks; everything else is left to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == (self.origin,):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.members = wanted if self.members is None else self.members & wanted
            else:
                yield f

    def partitions(self) -> list[Member]:
        found = [Member(archive, member) for archive in archives_under(self.path) for member in members_of(archive)]
        chosen = [m for m in found if self.members is None or m.member in self.members]
        return chosen or [Member("", "")]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        records = _records(partition.archive, partition.member, self.sep, self.encoding)
        header = [name.strip() for name in next(records, [])]
        if self.strict and (unknown := sorted(set(header) - set(self.names))):
            raise ValueError(f"{partition.member} has columns that are not listed: {unknown}")
        places = [header.index(n) if n in header else None for n in self.names]
        rows: list[list[str]] = []

        def batch() -> pa.RecordBatch:
            columns = [
                [partition.member if name == self.origin else r[i] if i is not None else "" for r in rows]
                for name, i in zip(self.names, places)
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], self.names)

        for number, record in enumerate(records, 1):
            if not record:
                continue
            if len(record) != len(header):
                raise ValueError(f"record {number} of {partition.member} has {len(record)} values, its header {len(header)}")
            rows.append(record)
            if len(rows) == BATCH_ROWS:
                yield batch()
                rows = []
        if rows:
            yield batch()


def register_zipped_csv(spark: SparkSession) -> None:
    """Make the format known to a session and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZippedCsvSource)
