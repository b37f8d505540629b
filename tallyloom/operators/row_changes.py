"""Which rows changed between two states of a table, found through a tree of bucket fingerprints.

A state is stored as rows in buckets of their key's hash, and as a tree over the buckets: a node holds
the row count and the row sums of all buckets below it.  Sums add up, so upper levels come from the
leaves without reading rows.  Two states are compared from the root down, only below nodes that differ,
and only the rows of buckets that differ are read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyloom.operators.changes import row_sums, row_text
from tallyloom.session import durable

FAN_BITS = 4
MAX_DEPTH = 4
INSERT, DELETE, EDIT = "insert", "delete", "edit"
_SUMS = ("row_count", "sum_0", "sum_1", "sum_2", "sum_3")
_TREE = (
    "node int, row_count long, sum_0 decimal(38,0), sum_1 decimal(38,0), sum_2 decimal(38,0), "
    "sum_3 decimal(38,0), described string, level int"
)


def _fields(names: Sequence[str]) -> list[Column]:
    return [F.col(f"row.`{name}`") for name in names]


def _rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    stored = StructType([StructField("row", schema), StructField("bucket", IntegerType())])
    return spark.read.schema(stored).parquet(f"{path}/rows")


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.schema(_TREE).parquet(f"{path}/tree").where(F.col("level") == level)


def _described(spark: SparkSession, path: str) -> tuple[StructType, list[str], int]:
    told = json.loads(_level(spark, path, 0).first()["described"])
    return StructType.fromJson(told["schema"]), told["keys"], told["depth"]


def publish_state(df: DataFrame, path: str, keys: Sequence[str], depth: int = 2) -> None:
    """Store ``df`` under a new ``path`` in ``16 ** depth`` buckets, the tree last.

    Keys may be missing and may repeat; an empty table is a state like others.  A bucket of much data is
    written by several tasks.  A state whose tree is missing is unfinished and cannot be read.
    """
    if not 1 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must be 1 to {MAX_DEPTH}")
    if missing := [key for key in keys if key not in df.columns]:
        raise ValueError(f"no such key columns: {missing}")
    spark, names = df.sparkSession, df.columns
    row = df.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"))
    bucket = F.pmod(F.xxhash64(row_text(_fields(keys))), F.lit(1 << FAN_BITS * depth)).cast("int")
    row.select("row", bucket.alias("bucket")).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{path}/rows")

    stored = _rows(spark, path, df.schema)
    leaves = durable(row_sums(stored, [f"row.`{name}`" for name in names], [F.col("bucket").alias("node")]), "leaves")
    totals = [F.sum(name).alias(name) for name in _SUMS]
    told = json.dumps({"schema": df.schema.jsonValue(), "keys": list(keys), "depth": depth})
    root = leaves.agg(*totals).fillna(0)
    tree = root.select(F.lit(0).alias("node"), *_SUMS, F.lit(told).alias("described"), F.lit(0).alias("level"))
    for level in range(1, depth + 1):
        above = F.shiftright("node", FAN_BITS * (depth - level)).alias("node")
        nodes = leaves.groupBy(above).agg(*totals)
        tree = tree.union(nodes.select("node", *_SUMS, F.lit(None).cast("string"), F.lit(level)))
    tree.coalesce(1).write.partitionBy("level").parquet(f"{path}/tree")


def differing_buckets(spark: SparkSession, before: str, after: str) -> list[int]:
    """Buckets whose rows differ, level by level below the nodes that differ.

    A level's nodes come to the driver: 16 ** depth numbers at most, whatever the tables' size.
    """
    depth = _described(spark, after)[2]
    differ: list[int] = []
    for level in range(depth + 1):
        old, new = (_level(spark, path, level).select("node", *_SUMS) for path in (before, after))
        if level:
            below = F.shiftright("node", FAN_BITS).isin(differ)
            old, new = old.where(below), new.where(below)
        found = old.subtract(new).union(new.subtract(old)).select("node").distinct()
        differ = sorted(r["node"] for r in found.collect())
        if not differ:
            break
    return differ


def changed_rows(spark: SparkSession, before: str, after: str) -> DataFrame:
    """``change, side, copies, row``: each row that one state holds more often than the other.

    ``side`` names the state with more copies and ``copies`` how many more.  ``change`` is ``insert`` for a
    key that only ``after`` has, ``delete`` for one that only ``before`` has, else ``edit``: the key's rows
    of both sides are then its old and new values.  A missing key value equals a missing one.  Equal
    states give no rows.  Columns must be of types that can be grouped.
    """
    schema, keys, depth = _described(spark, before)
    if (schema, keys, depth) != _described(spark, after):
        raise ValueError("states differ in columns, keys or depth")
    buckets = differing_buckets(spark, before, after)
    sides = [
        _rows(spark, path, schema).where(F.col("bucket").isin(buckets)).select("row", F.lit(own).alias("side"))
        for path, own in ((before, "before"), (after, "after"))
    ]
    counted = sides[0].union(sides[1]).groupBy("row").agg(
        *[F.count_if(F.col("side") == side).alias(side) for side in ("before", "after")]
    ).withColumn("key", row_text(_fields(keys)))
    per_key = counted.groupBy("key").agg(F.sum("before").alias("key_before"), F.sum("after").alias("key_after"))
    change = F.when(F.col("key_before") == 0, INSERT).when(F.col("key_after") == 0, DELETE).otherwise(EDIT)
    return counted.where("before <> after").join(per_key, "key").select(
        change.alias("change"), F.when(F.col("before") > F.col("after"), "before").otherwise("after").alias("side"),
        F.abs(F.col("after") - F.col("before")).alias("copies"), "row",
    )
