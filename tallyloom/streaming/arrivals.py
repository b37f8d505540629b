"""Refresh on arrival: new landing files rebuild only what depends on them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F, types as T

from tallyloom.operators.changes import refresh_if_changed, row_sums


def refresh_on_arrival(
    spark: SparkSession, landing: str, schema: T.StructType, name: str, state_path: str, checkpoint: str,
    rebuild: Callable[[DataFrame], object],
    read_all: Callable[[], DataFrame] | None = None,
) -> tuple[int, int]:
    """Take in the files that arrived since the last run, then stop.

    Returns the rebuilds and the rows hashed.  Only arrived files are hashed: their row sums are
    kept per micro-batch beside the state, and the table's fingerprint follows from all of them.
    ``rebuild`` gets the whole current table (``read_all``, by default everything in the landing
    folder) and runs if the fingerprint differs from what was last published.
    """
    rebuilds, hashed = [], []
    current = read_all or (lambda: spark.read.schema(schema).parquet(landing))
    sums_path = f"{state_path.rstrip('/')}-sums"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # A micro-batch that runs again after a failure replaces its own sums.
        row_sums(batch).write.mode("overwrite").parquet(f"{sums_path}/batch_id={batch_id}")
        stored = spark.read.parquet(f"{sums_path}/batch_id=*")
        hashed.append(spark.read.parquet(f"{sums_path}/batch_id={batch_id}").agg(F.sum("row_count")).first()[0] or 0)
        if not hashed[-1]:
            return
        as_of = datetime.now(timezone.utc)
        if refresh_if_changed(current(), name, state_path, rebuild, as_of, stored):
            rebuilds.append(batch_id)

    query = (
        spark.readStream.schema(schema).parquet(landing)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(rebuilds), sum(hashed)
