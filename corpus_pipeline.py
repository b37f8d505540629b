"""A training corpus from raw documents: five stages, each written before the next one reads it.

Toxic documents, exact copies, near copies and documents with benchmark passages go, in this order;
the rest is mixed to the sources' target weights.  Every stage but the last returns the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontamination, exact_dedup, ngram_join, source_mix, toxicity
from tallyloom.llm.registry import prepare, table
from tallyloom.session import durable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return source_mix.mix_sources(docs, table(spark, sf_dir, "labels"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_exact_copies),
    ("ngram_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("source_mix", mixed),
]

# A learned stage has no SQL; tests compare the pipeline with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through all stages; each result is stored as Parquet and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
