"""A running number over a total order, without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.session import durable

_POSITION_BITS = 33


def number_rows(
    df: DataFrame, order: Sequence[Column], name: str = "nr_ordem", partitions: int | None = None
) -> DataFrame:
    """Number rows 1..n in ``order``.

    Rows are range-partitioned and sorted inside each partition, and that layout is stored
    durably: range bounds are sampled, so a recomputed layout could differ.  Each row's place in
    its partition is then shifted by the rows of the partitions before it.  Only those partition
    counts meet in one task, and there are never more of them than partitions.
    """
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    place = F.monotonically_increasing_id()
    laid_out = durable(
        ranged.sortWithinPartitions(*order)
        .withColumn("__place", place)
        .withColumn("__part", F.shiftright("__place", _POSITION_BITS))
        .withColumn("__local", F.col("__place").bitwiseAND((1 << _POSITION_BITS) - 1))
        .drop("__place")
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid_out.groupBy("__part").count()
        .withColumn("__offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .select("__part", "__offset")
    )
    return (
        laid_out.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__local") + 1)
        .drop("__part", "__local", "__offset")
    )
