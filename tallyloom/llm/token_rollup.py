"""Token counts kept up to date by signed changes.

A change adds (+1) or takes away (-1) one document's count under one tokenizer version; a revised
count is the old one taken away and the new one added.  A batch is summed by source, language and
tokenizer version and stored under its number.  Sums add up in any order, so totals are the sum of
the stored batches, never a new count of the corpus.

Storing a batch replaces what is stored under its number, so a batch that is sent again after a
failure counts once.  ``fold`` sums the batches up to a number into one base; batches up to that
number are then closed and sending them again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.text import ascii_word_count, word_count
from tallyloom.session import durable, scratch_path

KEYS = ("source", "lang", "tokenizer")
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"


def changes(counted: DataFrame, sign: int, tokenizer: str, tokens: Column, id_col: str = "doc_id") -> DataFrame:
    """Signed rows ``doc_id, sign, source, lang, tokenizer, tokens``; a null count is 0."""
    return counted.select(
        F.col(id_col).cast("long").alias("doc_id"), F.lit(sign).alias("sign"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.lit(tokenizer).alias("tokenizer"),
        F.coalesce(tokens.cast("long"), F.lit(0)).alias("tokens"),
    )


def summed(rows: DataFrame) -> DataFrame:
    """Additive totals of signed rows; null sources and languages are groups of their own."""
    return rows.groupBy(*KEYS).agg(
        F.sum("sign").cast("long").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens")
    )


class Rollup:
    """Totals stored under one folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of complete parts, from the markers that Spark leaves after its last task."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/n=*/_SUCCESS"))
        return sorted(int(f.getPath().getParent().getName()[2:]) for f in found) if found else []

    def commit(self, number: int, rows: DataFrame) -> None:
        """Store a batch; sending it again replaces it, and a closed batch is left as it is."""
        bases = self._numbers("base")
        if bases and number <= bases[-1]:
            return
        # One small file per batch and 32 keys or so at most, whatever the batch holds.
        summed(rows).coalesce(8).write.mode("overwrite").parquet(f"{self.path}/batch/n={number}")

    def _parts(self) -> list[str]:
        bases = self._numbers("base")
        last = bases[-1] if bases else None
        parts = [f"{self.path}/base/n={last}"] if bases else []
        return parts + [f"{self.path}/batch/n={n}" for n in self._numbers("batch") if last is None or n > last]

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, docs, tokens``; groups without documents or tokens are left out."""
        parts = self._parts()
        read = self.spark.read.schema(TOTALS)
        stored = read.parquet(*parts) if parts else self.spark.createDataFrame([], TOTALS)
        return (
            stored.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where("docs <> 0 OR tokens <> 0")
        )

    def fold(self, number: int) -> None:
        """Sum everything up to ``number`` into a base; folding again changes nothing."""
        bases = self._numbers("base")
        if bases and number <= bases[-1]:
            return
        older = [f"{self.path}/base/n={bases[-1]}"] if bases else []
        older += [f"{self.path}/batch/n={n}" for n in self._numbers("batch") if n <= number and (not bases or n > bases[-1])]
        read = self.spark.read.schema(TOTALS)
        stored = read.parquet(*older) if older else self.spark.createDataFrame([], TOTALS)
        stored.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).coalesce(8).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/base/n={number}")


def vocabulary_counter(path: str, pattern: str) -> Callable[[Column], Column]:
    """Counts by a byte-pair vocabulary file of ranks and its splitting pattern.

    The path must be readable on every executor.  Whole texts are counted; null counts as empty.
    """

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import base64

        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        coder = tiktoken.Encoding("counting", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for texts in parts:
            yield pd.Series([len(coder.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count


SQL = r"""
WITH d AS (
  SELECT doc_id, source, lang,
    length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'),
                          '[\x20\x09-\x0D]', '', 'g')) AS spaced,
    len([x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')
         IF x <> '']) AS worded
  FROM documents
), low AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0)
SELECT source, lang, tokenizer, count(*) AS docs, sum(tokens)::BIGINT AS tokens FROM (
  SELECT source, lang, 'spaces-1' AS tokenizer, spaced AS tokens FROM d WHERE doc_id NOT IN (SELECT doc_id FROM low)
  UNION ALL
  SELECT source, lang, 'words-1', worded FROM d WHERE doc_id NOT IN (SELECT doc_id FROM low)
) GROUP BY source, lang, tokenizer
"""


@query("op10_token_rollup", SQL)
def token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents arrive, one tokenizer's counts are revised, and low-quality documents go.

    The first words count is by white space and is then revised for every document; one batch is
    sent twice.
    """
    docs = table(spark, sf_dir, "documents")
    counted = durable(
        docs.select("doc_id", "source", "lang", word_count(F.col("text")).alias("spaced"),
                    ascii_word_count(F.col("text")).alias("worded")),
        "token-counts",
    )
    low = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id").distinct()
    gone = counted.join(low, "doc_id", "left_semi")
    spaced, worded = F.col("spaced"), F.col("worded")
    store = Rollup(spark, scratch_path(spark, "token-rollup"))
    store.commit(1, changes(counted, 1, "spaces-1", spaced).union(changes(counted, 1, "words-1", spaced)))
    store.fold(1)
    revised = changes(counted, -1, "words-1", spaced).union(changes(counted, 1, "words-1", worded))
    store.commit(2, revised)
    store.commit(2, revised)
    store.commit(3, changes(gone, -1, "spaces-1", spaced).union(changes(gone, -1, "words-1", worded)))
    return store.totals()
