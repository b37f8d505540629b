"""Named sources, chosen by list and landed one by one."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sinks.raw_tables import land_table

Extractor = Callable[[], DataFrame]


def select_sources(registry: Mapping[str, Extractor], wanted: str | None) -> list[str]:
    """Names from a comma-separated list, all when it is not given; unknown names are refused."""
    names = list(registry) if wanted is None else [n.strip() for n in wanted.split(",") if n.strip()]
    unknown = sorted(set(names) - set(registry))
    if unknown:
        raise ValueError(f"unknown sources: {unknown}")
    return names


def land_sources(
    spark: SparkSession, registry: Mapping[str, Extractor], root: str, wanted: str | None = None,
    publish: bool = True,
) -> DataFrame:
    """Land each source; one that fails does not stop the others.

    Returns one row ``(source, status, rows, error)`` per source; callers treat any status other
    than ``ok`` as a failed load.
    """
    outcome = []
    for name in select_sources(registry, wanted):
        try:
            rows = land_table(registry[name](), root, name, publish=publish)
            outcome.append((name, "ok", rows, None))
        except Exception as failure:  # any failure is reported, and the next source still runs
            outcome.append((name, "failed", None, str(failure)))
    return spark.createDataFrame(outcome, "source string, status string, rows long, error string")
