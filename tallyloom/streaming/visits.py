"""Counting devices whose id is forgotten some time after it was counted.

An id counts when it is first seen, and again at the first visit at least ``ttl`` after it was
last counted.  Visits in between do not renew the wait.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyloom.session import durable

# --- fixed values: accepted shape of a device id, and how long one is remembered -----------
DEVICE_ID_PATTERN = r"(?i)^[a-z0-9-]{8,64}$"
REMEMBERED_FOR = timedelta(days=400)
# -------------------------------------------------------------------------------------------
STATE_STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTED_SCHEMA = "id string, counted_at timestamp"


def valid_visits(visits: DataFrame, id_column: str = "id") -> DataFrame:
    """Visits whose id has the accepted shape."""
    return visits.filter(F.col(id_column).rlike(DEVICE_ID_PATTERN))


def _micros(ttl: timedelta) -> int:
    return int(ttl.total_seconds() * 1_000_000)


class DeviceCounter(StatefulProcessor):
    """Keeps, per id, the moment it was last counted."""

    def __init__(self, ttl: timedelta) -> None:
        self.ttl = np.int64(_micros(ttl))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_counted", "micros long")

    def handleInputRows(
        self, key, rows: Iterator[pd.DataFrame], timer_values
    ) -> Iterator[pd.DataFrame]:
        # Only the id's visits of one micro-batch, eight bytes each; visits too early to count
        # are dropped as they are read.
        due = self.last.get()[0] + self.ttl if self.last.exists() else None
        parts = []
        for frame in rows:
            stamps = frame["micros"].to_numpy(dtype=np.int64)
            parts.append(np.unique(stamps if due is None else stamps[stamps >= due]))
        stamps = np.unique(np.concatenate(parts)) if parts else np.empty(0, dtype=np.int64)
        counted = []
        place = 0
        while place < len(stamps):
            counted.append(int(stamps[place]))
            place = int(np.searchsorted(stamps, stamps[place] + self.ttl, side="left"))
        if counted:
            self.last.update((counted[-1],))
            yield pd.DataFrame({
                "id": [key[0]] * len(counted),
                "counted_at": pd.to_datetime(counted, unit="us", utc=True),
            })

    def close(self) -> None:
        pass


def count_devices_stream(visits: DataFrame, ttl: timedelta = REMEMBERED_FOR) -> DataFrame:
    """Streaming form: one output row each time an id counts.  Needs the RocksDB state store.

    Visits are taken in micro-batch order; inside a micro-batch they are ordered by time.
    """
    keyed = valid_visits(visits).select("id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros")).groupBy("id")
    return keyed.transformWithStateInPandas(
        statefulProcessor=DeviceCounter(ttl), outputStructType=COUNTED_SCHEMA,
        outputMode="Append", timeMode="None",
    )


def count_devices_batch(visits: DataFrame, ttl: timedelta = REMEMBERED_FOR) -> DataFrame:
    """Batch twin, by rounds: each round finds every id's next counting visit as a minimum.

    Minima combine before the shuffle, so an id with most of the visits is no heavier than any
    other.  Counted visits of an id are at least ``ttl`` apart, so there are at most span / ttl
    + 1 rounds, and each stores only one row per id that is still active.
    """
    distinct = durable(
        valid_visits(visits).filter(F.col("ts").isNotNull())
        .select("id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros")).distinct()
    )
    ttl_micros = _micros(ttl)

    def timed(frame: DataFrame) -> DataFrame:
        return frame.select("id", F.timestamp_micros("micros").alias("counted_at"))

    last = durable(distinct.groupBy("id").agg(F.min("micros").alias("micros")))
    counted = timed(last)
    while True:
        due = last.select("id", (F.col("micros") + ttl_micros).alias("due"))
        following = durable(
            distinct.join(due, "id").filter(F.col("micros") >= F.col("due"))
            .groupBy("id").agg(F.min("micros").alias("micros"))
        )
        if following.isEmpty():
            return counted
        counted = counted.unionByName(timed(following))
        last = following


def running_total(counted: DataFrame) -> DataFrame:
    """Devices counted per day and in total so far; one row per day meets in the window."""
    per_day = counted.groupBy(F.to_date("counted_at").alias("day")).agg(
        F.count(F.lit(1)).alias("counted")
    )
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.withColumn("total", F.sum("counted").over(so_far))


def visits_per_day(visits: DataFrame, ts: Column, watermark: str | None = None) -> DataFrame:
    """Plain count per day, for batch and for streams; set ``watermark`` on a stream."""
    stamped = visits.select(ts.cast("timestamp").alias("ts"))
    if watermark is not None:
        stamped = stamped.withWatermark("ts", watermark)
    counts = stamped.groupBy(F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("visits"))
    return counts.select(F.to_date("window.start").alias("day"), "visits")
