"""Type-2 history of a keyed table, by comparison of chosen columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BOOKKEEPING = ("version_id", "valid_from", "valid_to", "is_deleted")


def empty_history(source: DataFrame) -> DataFrame:
    """A history without rows for tables shaped like ``source``."""
    return (
        source.limit(0)
        .withColumn("version_id", F.lit(None).cast("string"))
        .withColumn("valid_from", F.lit(None).cast("timestamp"))
        .withColumn("valid_to", F.lit(None).cast("timestamp"))
        .withColumn("is_deleted", F.lit(None).cast("boolean"))
    )


def apply_snapshot(
    history: DataFrame, source: DataFrame, key: str, checked: Sequence[str], as_of: datetime
) -> DataFrame:
    """The history after one more state of the source.

    A row opens a new version when it is new, when a checked column changed (NULL counts as a
    value), or when it returns.  A row that vanished gets a closing version marked deleted.
    Running the same state twice changes nothing.  Closed versions pass through untouched; only
    open ones meet the source, in one join by key.
    """
    columns = list(source.columns)
    stamp = F.lit(as_of).cast("timestamp")
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull()).select(
        F.struct(*columns, *BOOKKEEPING).alias("old"), F.col(key).alias("__old_key")
    )
    incoming = source.select(F.struct(*columns).alias("new"), F.col(key).alias("__new_key"))
    joined = current.join(incoming, F.col("__old_key") == F.col("__new_key"), "full_outer")

    same = reduce(and_, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in checked])
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    was_deleted = F.col("old.is_deleted")
    kept = has_old & F.when(has_new, same & ~was_deleted).otherwise(was_deleted)

    def version(origin: str, valid_from, valid_to, deleted):
        identity = F.sha2(
            F.concat_ws("|", F.col(f"{origin}.{key}").cast("string"), valid_from.cast("string")), 256
        )
        return F.struct(
            *[F.col(f"{origin}.{c}").alias(c) for c in columns],
            identity.alias("version_id"), valid_from.alias("valid_from"),
            valid_to.alias("valid_to"), deleted.alias("is_deleted"),
        )

    still_open = F.lit(None).cast("timestamp")
    unchanged = version("old", F.col("old.valid_from"), still_open, was_deleted)
    ended = version("old", F.col("old.valid_from"), stamp, was_deleted)
    opened = version("new", stamp, still_open, F.lit(False))
    tombstone = version("old", stamp, still_open, F.lit(True))
    versions = (
        F.when(kept, F.array(unchanged))
        .when(has_old & has_new, F.array(ended, opened))
        .when(has_old, F.array(ended, tombstone))
        .otherwise(F.array(opened))
    )
    moved = joined.select(F.explode(versions).alias("v")).select("v.*")
    return closed.select(*columns, *BOOKKEEPING).unionByName(moved)


_OPEN, _CLOSED, _CURRENT = "open", "closed", "current"
_STATE = "%Y%m%dT%H%M%S%f"


def _last_state(spark: SparkSession, root: str, before: str | None = None) -> str | None:
    """The latest published state, or the latest before another; none before the first."""
    try:
        states = spark.read.schema("state string").parquet(f"{root}/{_CURRENT}")
    except AnalysisException as missing:  # nothing is published before the first state
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None
    return (states.filter(F.col("state") < before) if before else states).agg(F.max("state")).first()[0]


def publish_history(history: DataFrame, root: str, as_of: datetime) -> str:
    """Publish the history after one more state; readers move on only when all of it is stored.

    Closed versions never change, so only those closed since the state published before are
    written, beside earlier ones; open versions are written anew.  A last small file names the state
    that readers take.  Publishing the same state again replaces its own files.  Returns its name, which
    is ``as_of`` in UTC; without a zone it is taken in the driver's, as :func:`apply_snapshot` does.
    """
    root, state = root.rstrip("/"), f"{as_of.astimezone(timezone.utc):{_STATE}}"
    before = _last_state(history.sparkSession, root, state)
    ended = history.filter(F.col("valid_to").isNotNull())
    if before is not None:
        ended = ended.filter(F.col("valid_to") > F.lit(datetime.strptime(before, _STATE).replace(tzinfo=timezone.utc)))
    ended.write.mode("overwrite").parquet(f"{root}/{_CLOSED}/as_of={state}")
    history.filter(F.col("valid_to").isNull()).write.mode("overwrite").parquet(f"{root}/{_OPEN}/as_of={state}")
    history.sparkSession.createDataFrame([(state,)], "state string").coalesce(1).write.mode("append").parquet(
        f"{root}/{_CURRENT}"
    )
    return state


def read_history(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The history as last published, empty before the first state; ``schema`` is that of :func:`empty_history`."""
    root = root.rstrip("/")
    state = _last_state(spark, root)
    if state is None:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("as_of", T.StringType())])
    closed = spark.read.schema(stored).parquet(f"{root}/{_CLOSED}").filter(F.col("as_of") <= state)
    current = spark.read.schema(schema).parquet(f"{root}/{_OPEN}/as_of={state}")
    return closed.select(*schema.names).unionByName(current)
