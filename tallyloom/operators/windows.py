"""Per-key choices and ordered windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tallyloom.operators.joins import attach_group_values
from tallyloom.operators.numbering import number_rows

# Rows of one window task when a series is cut into ranges.
RANGE_ROWS = 500_000


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row per key; end ``order`` with a tie-breaker.  NULL keys form one key.

    Spark keeps only the first row per key of each task before the shuffle, so a hot key sends
    at most one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def windows_in_ranges(
    df: DataFrame, series: Sequence[str], order: Sequence[Column], before: int, after: int,
    columns: Callable[[WindowSpec], dict[str, Column]], range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Window columns over series of any length, none of which is gathered in one task.

    Rows are numbered over (series, order) and cut into ranges of ``range_rows``; a range also
    receives the ``before`` rows in front of it and the ``after`` rows behind it, computes, and
    keeps its own rows.  ``columns`` gets the ordered window and must not look further than
    ``before`` and ``after``.  End ``order`` with a tie-breaker, or ties come in any order.
    NULL series values form one series.
    """
    if before < 0 or after < 0:
        raise ValueError("the rows before and after must not be negative")
    width = max(range_rows, before, after, 1)
    numbered = number_rows(df, [*[F.asc(c) for c in series], *order], "__n")
    zero_based = F.col("__n") - 1
    home, place = F.floor(zero_based / width), zero_based % width
    reached = F.array_compact(F.array(
        home, F.when(place >= width - before, home + 1), F.when(place < after, home - 1)
    ))
    copies = numbered.withColumn("__home", home).withColumn("__range", F.explode(reached))
    window = Window.partitionBy("__range", *series).orderBy("__n")
    return (
        copies.withColumns(columns(window)).filter(F.col("__range") == F.col("__home"))
        .drop("__n", "__home", "__range")
    )


def day_gaps(
    df: DataFrame, groups: Sequence[str], day: str, range_rows: int | None = None
) -> DataFrame:
    """Days between neighbouring distinct days of each group (NULL for the first).

    A group holds at most one row per calendar day when the window runs.  ``range_rows`` cuts
    the days into ranges of that many rows instead, for groups finer than a task can hold.
    """
    days = df.select(*groups, day).distinct()

    def gap(window: WindowSpec) -> dict[str, Column]:
        return {"gap": F.datediff(F.col(day), F.lag(day).over(window))}

    if range_rows is not None:
        return windows_in_ranges(days, groups, [F.asc(day)], 1, 0, gap, range_rows)
    return days.withColumns(gap(Window.partitionBy(*groups).orderBy(day)))


def typical_gap(gap: Column, default: int) -> Column:
    """Median of the positive gaps, at least one day, ``default`` when there is none."""
    median = F.percentile_approx(F.when(gap > 0, gap), 0.5)
    return F.greatest(F.lit(1), F.coalesce(median, F.lit(default)))


def moving_average(
    df: DataFrame, series: Sequence[str], order: str | Sequence[str], value: str, name: str,
    half_width: int = 2, min_points: int = 15, range_rows: int | None = None,
) -> DataFrame:
    """Centred moving average, only for series with at least ``min_points`` points.

    As it stands it is meant for day series: one row per series and day, so a series stays
    small.  ``range_rows`` cuts series of any length into ranges of that many rows.  The points of
    a series are then counted beforehand, and a range sees ``half_width`` rows more on either side.
    """
    order = [order] if isinstance(order, str) else list(order)
    if range_rows is None:
        by_series = Window.partitionBy(*series)
        mean = F.avg(value).over(by_series.orderBy(*order).rowsBetween(-half_width, half_width))
        return df.withColumn(name, F.when(F.count(F.lit(1)).over(by_series) >= min_points, mean))
    counted = attach_group_values(df, series, __points=F.count(F.lit(1)))
    enough = counted.withColumn("__enough", F.col("__points") >= min_points).drop("__points")

    def mean_of_enough(window: WindowSpec) -> dict[str, Column]:
        return {name: F.when(F.col("__enough"), F.avg(value).over(window.rowsBetween(-half_width, half_width)))}

    return windows_in_ranges(
        enough, series, [F.asc(c) for c in order], half_width, half_width, mean_of_enough, range_rows
    ).drop("__enough")
