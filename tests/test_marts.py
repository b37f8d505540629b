import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.sinks.marts import (
    drop_old_versions, heaviest_key_share, published_version, replace_days, store_mart, versions,
)

DAY = datetime.date(2024, 1, 1)


@pytest.fixture()
def database(spark):
    name = "marts_under_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def facts(spark, days=3, rows=300):
    return spark.range(rows).select(
        (F.col("id") % 97).alias("poll"), F.col("id").alias("v"),
        F.date_add(F.lit(DAY), (F.col("id") % days).cast("int")).alias("day"),
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_marts_join_without_exchange(spark, database):
    left = store_mart(facts(spark), database, "answers", ["poll"], 8, "day")
    right = store_mart(facts(spark).groupBy("poll").agg(F.sum("v").alias("total")), database, "polls", ["poll"], 8)
    joined = spark.table(left).hint("merge").join(spark.table(right), "poll")
    assert "Exchange" not in plan(joined)
    per_poll = spark.table(left).groupBy("poll").agg(F.max("v").alias("top"))
    assert "Exchange" not in plan(per_poll)
    assert joined.count() == 300
    assert content(per_poll) == content(facts(spark).groupBy("poll").agg(F.max("v")))


def test_hot_keys_are_not_bucketed(spark, database):
    hot = facts(spark).withColumn("poll", F.when(F.col("v") % 3 == 0, F.lit(5)).otherwise(F.col("poll")))
    assert heaviest_key_share(hot, ["poll"]) > 1 / 3
    assert heaviest_key_share(hot.limit(0), ["poll"]) == 0
    store_mart(hot, database, "hot", ["poll"], 64)
    columns = spark.catalog.listColumns(f"{database}.{published_version(spark, database, 'hot')}")
    assert not any(c.isBucket for c in columns)
    assert content(spark.table(f"{database}.hot")) == content(hot)


def test_only_changed_days_are_written(spark, database):
    mart = store_mart(facts(spark), database, "daily", ["poll"], 4, "day")

    def files():
        found = spark.table(mart).select("day", F.input_file_name().alias("f")).distinct().collect()
        return {(r.day, r.f) for r in found}

    before = files()
    changed = facts(spark).filter(F.col("day") == F.lit(DAY)).limit(10).select("day", F.lit(-1).cast("long").alias("v"), "poll")
    new_day = facts(spark).limit(1).withColumn("day", F.lit(datetime.date(2030, 1, 1)))
    replace_days(spark, changed.unionByName(new_day), database, "daily")
    after = files()
    assert {f for d, f in before if d != DAY} <= {f for _, f in after}
    assert not {f for d, f in before if d == DAY} & {f for _, f in after}
    per_day = {r.day: (r["count"], r["sum"]) for r in spark.table(mart).groupBy("day").agg(
        F.count("v").alias("count"), F.sum("v").alias("sum")).collect()}
    assert per_day[DAY] == (10, -10) and len(per_day) == 4
    assert "Exchange" not in plan(spark.table(mart).groupBy("poll").count())
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_mart_is_rebuilt_from_itself_and_failures_leave_it(spark, database):
    mart = store_mart(facts(spark), database, "self", ["poll"], 4)
    store_mart(spark.table(mart).withColumn("v", F.col("v") + 1), database, "self", ["poll"], 4)
    wanted = content(facts(spark).withColumn("v", F.col("v") + 1))
    assert content(spark.table(mart)) == wanted
    with pytest.raises(Exception, match="no such luck"):
        store_mart(spark.table(mart).withColumn("v", F.raise_error(F.lit("no such luck"))), database, "self")
    assert content(spark.table(mart)) == wanted
    kept = published_version(spark, database, "self")
    drop_old_versions(spark, database, "self")
    assert versions(spark, database, "self") == [kept] and content(spark.table(mart)) == wanted


def test_empty_marts_and_wrong_arguments(spark, database):
    mart = store_mart(facts(spark).limit(0), database, "none", ["poll"], 4, "day")
    assert spark.table(mart).count() == 0
    replace_days(spark, facts(spark), database, "none")
    assert spark.table(mart).count() == 300
    with pytest.raises(ValueError):
        store_mart(facts(spark), database, "x", ["poll"])
    store_mart(facts(spark), database, "whole")
    with pytest.raises(ValueError, match="partitioned"):
        replace_days(spark, facts(spark), database, "whole")
