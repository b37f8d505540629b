"""Exact duplicates by Grace hashing.

Every task feeds its records to a table of complete contents.  Contents that no longer fit are
dealt to spill files by bits of their hash, and each file is treated the same way with the next
bits, until a bucket fits.  The tables use open addressing and compare complete contents, so equal
hashes of different texts stay apart.

The method runs twice.  The first pass stays in the task that scanned the rows and leaves one record
per content and task, so that a text with a third of all rows crosses the network once per task.
The second pass meets the records of one hash in one task.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.text import one_space, row_name, unused

RECORD = "hash long, content string, keep_id long, group_size long"
TABLE_BYTES = 64 << 20
FAN_OUT = 16
_ENTRY_BYTES = 200


class ContentTable:
    """Open addressing with linear probing; an entry is [hash, content, smallest id, rows]."""

    def __init__(self, budget: int):
        self.budget, self.used = budget, 0
        self.entries: list[list] = []
        self.slots = [-1] * 1024

    def _find(self, hash_: int, content: str) -> int:
        mask = len(self.slots) - 1
        at = hash_ & mask
        while (held := self.slots[at]) >= 0:
            entry = self.entries[held]
            if entry[0] == hash_ and entry[1] == content:
                break
            at = (at + 1) & mask
        return at

    def add(self, hash_: int, content: str, keep_id: int | None, rows: int) -> bool:
        """False when the content is new and no longer fits."""
        at = self._find(hash_, content)
        if (held := self.slots[at]) >= 0:
            entry = self.entries[held]
            entry[3] += rows
            if keep_id is not None and (entry[2] is None or keep_id < entry[2]):
                entry[2] = keep_id
            return True
        size = len(content) + _ENTRY_BYTES
        if self.entries and self.used + size > self.budget:
            return False
        self.used += size
        self.slots[at] = len(self.entries)
        self.entries.append([hash_, content, keep_id, rows])
        if 3 * len(self.entries) > 2 * len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for place, entry in enumerate(self.entries):
                self.slots[self._find(entry[0], entry[1])] = place
        return True


def _stored(path: str) -> Iterator[tuple]:
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def grace_classes(
    records: Iterable[tuple], budget: int, folder: str, level: int = 0
) -> Iterator[list]:
    """One entry per content.  ``folder`` belongs to the task and goes with it."""
    held = ContentTable(budget)
    spills: dict[int, object] = {}
    paths: dict[int, str] = {}
    try:
        for record in records:
            if held.add(*record):
                continue
            # The table's low bits pick slots, so buckets use bits from the top.
            bucket = (record[0] >> (60 - 4 * level) if level < 15 else record[0]) % FAN_OUT
            if bucket not in spills:
                paths[bucket] = f"{folder}/{level}-{id(held)}-{bucket}"
                spills[bucket] = open(paths[bucket], "wb")
            pickle.dump(record, spills[bucket])
    finally:
        for file in spills.values():
            file.close()
    yield from held.entries
    del held
    for path in paths.values():
        yield from grace_classes(_stored(path), budget, folder, level + 1)


def _merge(budget: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records():
            for frame in frames:
                ids = [None if pd.isna(x) else int(x) for x in frame["keep_id"]]
                yield from zip(frame["hash"].tolist(), frame["content"].tolist(), ids,
                               frame["group_size"].tolist())

        with tempfile.TemporaryDirectory() as folder:
            block, size = [], 0
            for entry in grace_classes(records(), budget, folder):
                block.append(entry)
                size += len(entry[1]) + _ENTRY_BYTES
                if size > 4 << 20:
                    yield _frame(block)
                    block, size = [], 0
            if block:
                yield _frame(block)

    return run


def _frame(block: list[list]) -> pd.DataFrame:
    hashes, contents, ids, rows = zip(*block)
    return pd.DataFrame({
        "hash": hashes, "content": contents, "keep_id": pd.array(ids, dtype="Int64"),
        "group_size": rows,
    })


def content_classes(
    docs: DataFrame, id_col: str = "doc_id", content: Column | None = None, budget: int = TABLE_BYTES
) -> DataFrame:
    """Classes of equal contents: ``text_sha256, keep_id, group_size``.

    ``content`` defaults to the text with each run of white space as one space; null counts as
    empty.  ``keep_id`` is the smallest id that is not null, or null if all are.  An empty table
    gives no class.
    """
    content = one_space(F.col("text")) if content is None else content
    records = docs.select(content.alias("content"), F.col(id_col).cast("long").alias("keep_id"))
    records = records.select(
        F.xxhash64("content").alias("hash"), "content", "keep_id", F.lit(1).cast("long").alias("group_size")
    )
    merge = _merge(budget)
    classes = records.mapInPandas(merge, RECORD).repartition("hash").mapInPandas(merge, RECORD)
    return classes.select(F.sha2("content", 256).alias("text_sha256"), "keep_id", "group_size")


def mark_copies(docs: DataFrame, id_col: str = "doc_id", budget: int = TABLE_BYTES) -> DataFrame:
    """One narrow row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the smallest id stays.  Rows that repeat that id with the same text
    are the same document; one of them stays.  Rows without an id: one stays if its class has no id.
    """
    classes = content_classes(docs, id_col, budget=budget)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.sha2(one_space(F.col("text")), 256).alias("text_sha256")
    )
    repeat = F.row_number().over(Window.partitionBy("doc_id", "text_sha256").orderBy("doc_id"))
    return rows.join(classes, "text_sha256").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (repeat == 1)).alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", budget: int = TABLE_BYTES) -> DataFrame:
    """The documents that stay, with all their columns.

    Of rows that repeat an id with the same text, the one with the smallest row hash stays.
    """
    names = docs.columns
    row, content, place = (unused(docs, n) for n in ("__row", "__content", "__place"))
    keepers = content_classes(docs, id_col, budget=budget).select(
        row_name(F.col("keep_id"), F.col("text_sha256")).alias(row)
    )
    sha = F.sha2(one_space(F.col("text")), 256)
    first = F.row_number().over(Window.partitionBy(row).orderBy(content))
    rows = docs.withColumns({row: row_name(F.col(id_col), sha), content: F.xxhash64(*names)})
    return rows.join(keepers, row).withColumn(place, first).where(F.col(place) == 1).select(*names)


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""


@query("op2_exact_dedup", SQL)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents"))
