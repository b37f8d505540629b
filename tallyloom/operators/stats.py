"""Poll statistics: rescaling, day means, smoothing, ranges, duels, rounding.

Inputs are reduced to one row per (poll, label) before anything is divided, so later groups hold
at most one row per label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.classify import CANDIDATE
from tallyloom.operators.windows import moving_average

NON_RESPONSE_SLICE = "NR"
SHARE_TYPE = "decimal(18,6)"


def poll_means(df: DataFrame, poll: list[str], label: str, kind: str, value: str) -> DataFrame:
    """Mean over the scenarios of one poll, per label.  Decimal input keeps it order-free."""
    return df.groupBy(*poll, label, kind).agg(F.avg(value).alias(value))


def rescale_polls(df: DataFrame, poll: list[str], label: str, kind: str, value: str) -> DataFrame:
    """Each poll scaled to 100, with every non-response label in one slice."""
    sliced = df.withColumn(
        label, F.when(F.col(kind) == CANDIDATE, F.col(label)).otherwise(NON_RESPONSE_SLICE)
    )
    per_slice = sliced.groupBy(*poll, label).agg(F.sum(value).alias(value))
    total = F.sum(value).over(Window.partitionBy(*poll))
    return per_slice.withColumn(value, F.try_divide(F.col(value) * 100, total).cast(SHARE_TYPE))


def day_means(df: DataFrame, poll: list[str], day: str, label: str, value: str) -> DataFrame:
    """Mean of the polls ending on a day; a label absent from a poll counts as zero there."""
    polls = df.select(day, *poll).distinct().groupBy(day).agg(F.count(F.lit(1)).alias("polls"))
    sums = df.groupBy(day, label).agg(F.sum(value).alias("total"))
    return sums.join(polls, day).select(
        day, label, "polls", (F.col("total") / F.col("polls")).cast(SHARE_TYPE).alias(value)
    )


def smoothed(df: DataFrame, day: str, label: str, value: str, name: str = "media_movel") -> DataFrame:
    """Centred five-point mean for labels seen on more than 14 days."""
    return moving_average(df, [label], day, value, name, half_width=2, min_points=15)


def period_bars(
    df: DataFrame, day: str, label: str, value: str, first_day: Column, last_day: Column
) -> DataFrame:
    """Mean, lowest and highest over the polls of a period in which the label appears."""
    inside = df.filter(F.col(day).between(first_day, last_day))
    return inside.groupBy(label).agg(
        F.count(F.lit(1)).alias("polls"), F.avg(value).cast(SHARE_TYPE).alias("mean"),
        F.min(value).alias("low"), F.max(value).alias("high"),
    )


def rescale_duel(high: Column, low: Column, undecided: Column) -> list[Column]:
    """Leader, runner-up and undecided scaled to 100; missing undecided is the gap to 100."""
    gap = F.coalesce(undecided, F.lit(100) - high - low)
    total = high + low + gap
    return [F.try_divide(part * 100, total).cast(SHARE_TYPE) for part in (high, low, gap)]


def largest_remainder(
    df: DataFrame, group: list[str], label: str, value: str, name: str, total: int = 100
) -> DataFrame:
    """Round to one decimal so each group adds up to ``total`` exactly.

    Every value is cut to tenths; the tenths still missing go to the largest remainders, ties by
    label.  Works on exact decimals, over one row per label.
    """
    in_group = Window.partitionBy(*group)
    tenths = F.col(value).cast("decimal(18,6)") * 10
    by_remainder = in_group.orderBy(F.desc("__rest"), F.asc(label))
    return (
        df.withColumn("__floor", F.floor(tenths).cast("long"))
        .withColumn("__rest", tenths - F.col("__floor"))
        .withColumn("__missing", F.lit(total * 10) - F.sum("__floor").over(in_group))
        .withColumn("__place", F.row_number().over(by_remainder))
        .withColumn(
            name,
            (F.col("__floor") + (F.col("__place") <= F.col("__missing")).cast("long"))
            .cast("decimal(18,1)") / 10,
        )
        .withColumn(name, F.col(name).cast("decimal(9,1)"))
        .drop("__floor", "__rest", "__missing", "__place")
    )
