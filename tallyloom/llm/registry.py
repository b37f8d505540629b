"""Registration of the queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import tune

Runner = Callable[[SparkSession, str], DataFrame]
MODULES = (
    "license_scan", "exact_dedup", "source_mix", "html_blocks", "decontamination", "ngram_join", "passage_dedup",
    "toxicity", "language_id", "token_rollup", "periodic_runs", "personal_data", "vector_codes",
)
QUERIES: dict[str, Runner] = {}
SQL: dict[str, str] = {}

# Python workers take texts in small batches, so that memory follows the batch, not the table.
WORKER_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    for key, value in WORKER_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        QUERIES[name] = lambda spark, sf_dir: run(prepare(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> tuple[dict[str, Runner], dict[str, str]]:
    for module in MODULES:
        import_module(f"tallyloom.llm.{module}")
    return QUERIES, SQL
