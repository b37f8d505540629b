import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.quantiles import (
    day_sketches, merged_windows, rank_error, sketch_quantile, typical_gap_of,
)

FIRST = date(2024, 1, 1)
SCHEMA = "g string, day date, v long"


def test_merged_days_stay_near_the_exact_median(spark):
    days = F.date_add(F.lit(FIRST), (F.col("id") % 200).cast("int"))
    # One group holds nine tenths of the rows, and its values drift from day to day.
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("g"), days.alias("day"),
        (F.hash("id") % 1000 + F.col("id") % 200 * 5).cast("long").alias("v"),
    )
    end = FIRST + timedelta(days=150)
    windows = merged_windows(day_sketches(rows, ["g"], "day", "v"), ["g"], "day", [end], 120)
    medians = windows.select("g", sketch_quantile(F.col("sketch"), 0.5).alias("median"), "values", F.length("sketch").alias("bytes"))
    stored = {r.g: r for r in medians.collect()}
    seen = rows.filter((F.col("day") <= F.lit(end)) & (F.col("day") > F.lit(end - timedelta(days=120))))
    known = spark.createDataFrame([(g, r["median"]) for g, r in stored.items()], "g string, median long")
    for row in rank_error(seen.join(known, "g"), ["g"], "v", "median", 0.5).collect():
        assert row["values"] == stored[row.g]["values"]
        assert row.rank_error < 0.02
        assert stored[row.g]["bytes"] < 8000


def test_windows_cover_their_days_only(spark):
    draw = random.Random(3)
    rows = [(draw.choice("ab"), FIRST + timedelta(days=draw.randrange(60)), draw.randrange(50)) for _ in range(300)]
    df = spark.createDataFrame(rows + [("a", None, 1), ("a", FIRST, None), (None, FIRST, 9)], SCHEMA)
    ends = [FIRST + timedelta(days=d) for d in (0, 20, 45, 90)]
    windows = merged_windows(day_sketches(df, ["g"], "day", "v"), ["g"], "day", [*ends, ends[0]], 30)
    found = {
        (r.g, r.window_end): (r["values"], r.low, r.high)
        for r in windows.select(
            "*", sketch_quantile(F.col("sketch"), 0).alias("low"), sketch_quantile(F.col("sketch"), 1).alias("high")
        ).collect()
    }
    wanted = {}
    for g in ("a", "b", None):
        for end in ends:
            values = [v for k, d, v in [*rows, (None, FIRST, 9)] if k == g and end - timedelta(days=30) < d <= end]
            if values:
                wanted[g, end] = (len(values), min(values), max(values))
    assert found == wanted


def test_gap_rules(spark):
    assert spark.range(1).select(typical_gap_of(F.lit(None).cast("binary"), 7)).first()[0] == 7
    zeros = day_sketches(spark.createDataFrame([("a", FIRST, 0)], SCHEMA), [], "day", "v")
    assert zeros.select(typical_gap_of(F.col("sketch"), 7)).first()[0] == 1
    assert day_sketches(spark.createDataFrame([], SCHEMA), ["g"], "day", "v").count() == 0
    with pytest.raises(ValueError):
        merged_windows(zeros, [], "day", [FIRST], 0)
