"""Marts: stored tables that join without a shuffle, replaced as a whole or by days.

A mart is a view over the version of its table that is published.  A rebuild writes a new version
beside the old one and then moves the view, so readers never see a table that is missing or half
written, and a mart may be read while it is being rebuilt from itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# A key that holds more than this many times a bucket's even share would make one task of each
# join too large.  Its table is stored without buckets; joins then shuffle, and Spark splits it.
HOT_SHARE = 4.0


def heaviest_key_share(df: DataFrame, keys: Sequence[str]) -> float:
    """The share of all rows that the most frequent key holds; 0 for no rows."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = per_key.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return row["most"] / row["all"] if row["all"] else 0.0


def _quoted(database: str, name: str) -> str:
    return f"`{database}`.`{name}`"


def _write_version(
    df: DataFrame, database: str, name: str, keys: Sequence[str], buckets: int, day: str | None
) -> str:
    version = f"{name}__{uuid.uuid4().hex[:12]}"
    writer = df.write.format("parquet")
    if buckets and heaviest_key_share(df, keys) * buckets <= HOT_SHARE:
        # Rows of a bucket meet in one task first, which then writes one file per bucket and day.
        writer = df.repartition(buckets, *keys).write.format("parquet")
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    if day is not None:
        writer = writer.partitionBy(day)
    writer.saveAsTable(_quoted(database, version))
    return version


def store_mart(
    df: DataFrame, database: str, name: str, keys: Sequence[str] = (), buckets: int = 0, day: str | None = None
) -> str:
    """Write a new version of a mart, then publish it; returns the mart's full name.

    Two marts with the same ``keys`` and number of ``buckets`` join on them without an exchange.
    Rows with NULL keys share one bucket.  ``day`` names the column to partition by.  ``df`` is
    read twice where it is bucketed, first for its heaviest key: store it first if it is costly.
    """
    if bool(keys) != bool(buckets):
        raise ValueError("buckets need keys, and keys need a number of buckets")
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    version = _write_version(df, database, name, keys, buckets, day)
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(database, name)} AS SELECT * FROM {_quoted(database, version)}")
    return f"{database}.{name}"


def versions(spark: SparkSession, database: str, name: str) -> list[str]:
    """Stored versions of a mart, published or not."""
    return sorted(
        t.name for t in spark.catalog.listTables(database) if t.name.startswith(f"{name}__") and t.tableType != "VIEW"
    )


def published_version(spark: SparkSession, database: str, name: str) -> str:
    """The table that the mart's view reads."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(database, name)}").collect()
    text = next(r.data_type for r in rows if r.col_name == "View Text")
    return next(v for v in versions(spark, database, name) if f"`{v}`" in text)


def replace_days(spark: SparkSession, changed: DataFrame, database: str, name: str) -> None:
    """Replace the days that ``changed`` has rows of; other days are not read or written.

    The files of all these days are written aside and take their places when the job commits, day
    by day; a lost executor or a failed job leaves the mart as it was.  Readers that must see all
    changed days at once need ``store_mart``.  Columns are matched by name.
    """
    version = _quoted(database, published_version(spark, database, name))
    table = spark.table(version)
    days = [c.name for c in spark.catalog.listColumns(version) if c.isPartition]
    if not days:
        raise ValueError(f"{database}.{name} is not partitioned")
    buckets = [c.name for c in spark.catalog.listColumns(version) if c.isBucket]
    rows = changed.select(*table.columns)
    if buckets:
        number = spark.sql(f"DESCRIBE TABLE EXTENDED {version}").filter("col_name = 'Num Buckets'").first()
        rows = rows.repartition(int(number.data_type), *buckets)
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows.write.insertInto(version, overwrite=True)
    finally:
        spark.conf.set(setting, before)
    spark.catalog.refreshTable(version)


def drop_old_versions(spark: SparkSession, database: str, name: str) -> list[str]:
    """Drop the versions that are not published, once no reader needs them; returns their names."""
    kept = published_version(spark, database, name)
    old = [v for v in versions(spark, database, name) if v != kept]
    for version in old:
        spark.sql(f"DROP TABLE {_quoted(database, version)}")
    return old
