import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.windows import day_gaps, moving_average, windows_in_ranges


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("range_rows", [1, 7, 40, 10_000])
@pytest.mark.parametrize("half_width, min_points", [(0, 1), (2, 15), (9, 4)])
def test_means_by_ranges_equal_whole_series(spark, range_rows, half_width, min_points):
    draw = random.Random(range_rows)
    rows = [
        (name, place, draw.randrange(1000))
        for name, size in (("long", 150), ("fourteen", 14), ("fifteen", 15), ("one", 1), (None, 30))
        for place in range(size)
    ]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "s string, place int, v long")
    whole = moving_average(df, ["s"], "place", "v", "mean", half_width, min_points)
    cut = moving_average(df, ["s"], "place", "v", "mean", half_width, min_points, range_rows)
    assert rows_of(cut) == rows_of(whole)


def test_gaps_by_ranges(spark):
    draw = random.Random(5)
    rows = [(draw.choice("ab"), draw.randrange(400)) for _ in range(300)] + [(None, 3), ("a", None)]
    df = spark.createDataFrame(rows, "g string, n int").select(
        "g", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")).alias("day")
    )
    for groups in (["g"], []):
        assert rows_of(day_gaps(df, groups, "day", range_rows=9)) == rows_of(day_gaps(df, groups, "day"))


def test_one_series_is_shared_and_halos_are_small(spark):
    df = spark.range(10_000).withColumn("v", F.col("id") % 7)
    seen = windows_in_ranges(
        df, [], [F.asc("id")], 2, 1,
        lambda w: {"rows": F.count(F.lit(1)).over(w.rowsBetween(-9000, 9000))}, 1000,
    )
    # A range sees its own rows and three of its neighbours, whatever the window asks for.
    assert seen.agg(F.max("rows")).first()[0] == 1003
    assert seen.count() == 10_000
    # Left to itself Spark joins partitions as small as these.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert len(seen.groupBy(F.spark_partition_id()).agg(F.max("rows")).collect()) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_no_rows_and_wrong_reach(spark):
    empty = spark.createDataFrame([], "s string, place int, v long")
    assert moving_average(empty, ["s"], "place", "v", "mean", range_rows=5).count() == 0
    with pytest.raises(ValueError):
        windows_in_ranges(empty, ["s"], [F.asc("place")], -1, 0, lambda w: {})


def test_ranges_of_a_mean_see_half_its_width(spark, monkeypatch):
    asked = []

    def ranges(df, series, order, before, after, *rest):
        asked.append((before, after))
        return windows_in_ranges(df, series, order, before, after, *rest)

    monkeypatch.setattr("tallyloom.operators.windows.windows_in_ranges", ranges)
    df = spark.range(40).selectExpr("id % 2 AS s", "id", "id * 3 AS v")
    cut = moving_average(df, ["s"], "id", "v", "mean", 2, 15, 6)
    assert asked == [(2, 2)]
    assert rows_of(cut) == rows_of(moving_average(df, ["s"], "id", "v", "mean", 2, 15))
