"""Unpivoting chosen by the schema, and date series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def columns_with_suffix(df: DataFrame, suffix: str, excluded: Sequence[str] = ()) -> list[str]:
    """Columns whose name ends in ``suffix`` in any case, minus the excluded ones."""
    skip = {name.upper() for name in excluded}
    return [
        name for name in df.columns
        if name.strip().upper().endswith(suffix.upper()) and name.strip().upper() not in skip
    ]


def unpivot_columns(
    df: DataFrame, ids: Sequence[str], values: Sequence[str],
    name: str = "coluna_origem", value: str = "valor", value_type: str = "string",
    upper_names: bool = False,
) -> DataFrame:
    """One row per (row, chosen column) in a single pass; empty but typed when none is chosen."""
    if not values:
        kept = df.select(*ids).limit(0)
        return kept.withColumn(name, F.lit("")).withColumn(value, F.lit(None).cast(value_type))
    long = df.select(*ids, *[F.col(f"`{v}`").cast(value_type) for v in values]).unpivot(
        list(ids), list(values), name, value
    )
    return long.withColumn(name, F.upper(name)) if upper_names else long


def date_series(bounds: DataFrame, first: str, last: str, name: str = "dt") -> DataFrame:
    """One row per day between two dates, both included."""
    step = F.expr("interval 1 day")
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last), step)).alias(name))


def with_settled(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that are expensive to compute and that filters will look at.

    A filter on an ordinary computed column moves below the computation and repeats it, once per
    mention.  It cannot move below a generator, so here each column is computed once per row.
    """
    settled = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(settled)))
