"""One name per entity: canonical spellings, lookups by name key, most used names."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.cleaning import name_key
from tallyloom.operators.joins import lookup_join
from tallyloom.operators.windows import first_per_key
from tallyloom.session import durable


def canonical_spellings(
    df: DataFrame, column: str, cleaned: Callable[[Column], Column] = lambda c: c,
    key: Callable[[Column], Column] = name_key,
) -> DataFrame:
    """Map every spelling to the most used spelling with the same key, ties alphabetical.

    Rows collapse to distinct spellings before any key is computed, so the work after the first
    aggregate depends on the vocabulary only.  The map is stored, so its real size decides how it
    is joined: a small one is broadcast and the rows stay where they are.
    """
    spellings = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__uses"))
        .withColumn("__clean", cleaned(F.col(column)))
        .withColumn("__key", key(F.col("__clean")))
    )
    winners = spellings.groupBy("__key").agg(
        F.min_by("__clean", F.struct(-F.col("__uses"), F.col("__clean"))).alias("canonical")
    )
    return durable(
        spellings.join(winners, "__key").select(F.col(column).alias("spelling"), "canonical"),
        "spellings",
    )


def with_canonical(df: DataFrame, column: str, spellings: DataFrame, name: str) -> DataFrame:
    """Attach the canonical spelling; Spark broadcasts the map if its size allows."""
    mapped = spellings.withColumnsRenamed({"spelling": "__spelling", "canonical": name})
    return df.join(mapped, df[column] == mapped["__spelling"], "left").drop("__spelling")


def lookup_by_name_key(
    df: DataFrame, column: str, lookup: DataFrame, source: str, target: str, name: str
) -> DataFrame:
    """Left join on a computed name key; the lookup is first reduced to one row per key."""
    keyed = lookup.withColumn("__key", name_key(F.col(source)))
    one_per_key = first_per_key(keyed, ["__key"], [F.col(source).asc(), F.col(target).asc()])
    wanted = one_per_key.select("__key", F.col(target).alias(name))
    keyed_rows = df.withColumn("__row_key", name_key(F.col(column)))
    return lookup_join(keyed_rows, wanted, {"__row_key": "__key"}).drop("__row_key")


def most_used_per_key(
    df: DataFrame, key: str, names: Sequence[str], day: str,
    count: str = "qt", first: str = "dt_first", last: str = "dt_last",
) -> DataFrame:
    """Per key: the most used combination of ``names``, rows, first and last day.

    Ties go to the alphabetically first combination.
    """
    per_spelling = df.groupBy(key, *names).agg(
        F.count(F.lit(1)).alias("__uses"), F.min(day).alias("__min"), F.max(day).alias("__max")
    )
    combination = F.struct(*names)
    best = F.min_by(combination, F.struct(-F.col("__uses"), combination)).alias("__best")
    return (
        per_spelling.groupBy(key)
        .agg(best, F.sum("__uses").alias(count), F.min("__min").alias(first), F.max("__max").alias(last))
        .select(key, *[F.col(f"__best.{n}").alias(n) for n in names], count, first, last)
    )
