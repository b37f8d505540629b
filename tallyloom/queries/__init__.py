"""Registered queries over the benchmark tables, each with SQL that gives the same rows.

Messy text is derived from the typed tables inside the query, so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import spread, tune

Runner = Callable[[SparkSession, str], DataFrame]
MODULES = (
    "cleaning", "classification", "shaping", "windowing", "entities", "joining", "aggregates",
    "statistics", "changing", "checking", "ingesting", "streams", "facts", "panels",
)


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


REGISTERED: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query under a name, with equivalent SQL where SQL can express it."""

    def register(run: Runner) -> Runner:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)

        if name in REGISTERED:
            raise ValueError(f"query {name} is registered twice")
        REGISTERED[name] = Query(tuned, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for work that is heavy per row: a scan in few pieces is shared over the cores."""
    return spread(table(spark, sf_dir, name))


def load_all() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"tallyloom.queries.{module}")
    return REGISTERED
