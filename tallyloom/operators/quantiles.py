"""Quantiles that keep up with arriving days: one mergeable sketch per group and day.

A sketch takes about four kilobytes whatever its number of values, so windows of any length are
answered from stored days, and the rows behind them are read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The size that sets a sketch's accuracy; below that many values it holds all of them.
SKETCH_SIZE = 200


def day_sketches(
    df: DataFrame, groups: Sequence[str], day: str, value: str, size: int = SKETCH_SIZE
) -> DataFrame:
    """A sketch of the whole numbers ``value`` per group and day, and how many there are.

    Rows without a value or a day are left out.  Tasks sketch their own rows before the shuffle,
    so a hot group sends one sketch per task and day.
    """
    known = df.filter(F.col(value).isNotNull() & F.col(day).isNotNull())
    return known.groupBy(*groups, day).agg(
        F.kll_sketch_agg_bigint(F.col(value).cast("long"), size).alias("sketch"),
        F.count(F.lit(1)).alias("values"),
    )


def merged_windows(
    sketches: DataFrame, groups: Sequence[str], day: str, ends: Sequence, days: int, end: str = "window_end"
) -> DataFrame:
    """One merged sketch per group and window of ``days`` days up to each of ``ends``.

    ``ends`` are dates chosen by the caller, the last day of each window; a stored day takes part
    in every window that covers it.  Windows in which a group has no value have no row.
    """
    if days < 1:
        raise ValueError("a window has at least one day")
    chosen = F.array(*[F.lit(e).cast("date") for e in sorted(set(ends))])
    covering = F.filter(
        chosen, lambda e: (F.col(day) <= e) & (F.col(day) > F.date_sub(e, days))
    )
    return sketches.withColumn(end, F.explode(covering)).groupBy(*groups, end).agg(
        F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("values").alias("values")
    )


def sketch_quantile(sketch: Column, rank: float) -> Column:
    """The value at ``rank``, between 0 and 1; NULL for a missing sketch."""
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(rank)))


def typical_gap_of(sketch: Column, default: int) -> Column:
    """Median of the sketched gaps, at least one day, ``default`` where there are none."""
    return F.greatest(F.lit(1), F.coalesce(sketch_quantile(sketch, 0.5).cast("int"), F.lit(default)))


def rank_error(
    df: DataFrame, groups: Sequence[str], value: str, estimate: str, rank: float
) -> DataFrame:
    """How far the true rank of each group's ``estimate`` is from ``rank``, as a share of its values.

    ``df`` has the exact values, with the estimate of the group on each row.  Equal values cover a
    stretch of ranks; the error is 0 where ``rank`` lies inside it.
    """
    below = F.count_if(F.col(value) < F.col(estimate)) / F.count(F.lit(1))
    up_to = F.count_if(F.col(value) <= F.col(estimate)) / F.count(F.lit(1))
    return df.groupBy(*groups).agg(
        F.greatest(F.lit(0.0), below - rank, rank - up_to).alias("rank_error"),
        F.count(F.lit(1)).alias("values"),
    )
