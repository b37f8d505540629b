"""Streams whose state is bounded: days that close, visits sent twice, ids that expire.

An event-time watermark follows the latest visit at a set distance.  Counts of a day come out once, when
the watermark has passed the day; a visit that comes again is counted once; a device's state goes when
its waiting time is over.  Visits that come after the watermark can change nothing any more, so they go
to a table of their own instead of vanishing.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyloom.streaming.visits import COUNTED_SCHEMA, REMEMBERED_FOR, _micros, valid_visits


def closed_days(visits: DataFrame, watermark: str, key: tuple[str, ...] = ("visit_id",), ts: str = "ts") -> DataFrame:
    """Visits per day in append mode; a day comes out once, when no visit can be added to it any more.

    Visits of the same ``key`` count once if the second comes before the watermark passes the first by the
    watermark's delay.  State holds the keys and days since the watermark only.
    """
    stamped = visits.select(*key, F.col(ts).cast("timestamp").alias("ts")).withWatermark("ts", watermark)
    once = stamped.dropDuplicatesWithinWatermark(list(key))
    counts = once.groupBy(F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("visits"))
    return counts.select(F.to_date("window.start").alias("day"), "visits")


class LateVisits:
    """Keeps what comes too late, as ``foreachBatch`` of a stream over the same files.

    Each micro-batch stores its latest time under its number.  A visit is late when it is not after the
    latest time of the batches before the last one, less the delay: a stream with a watermark drops such
    visits, whose threshold is that of the batch before.  A batch that runs again replaces what it wrote.
    """

    def __init__(self, spark: SparkSession, path: str, delay: timedelta, ts: str = "ts") -> None:
        self.spark, self.path, self.delay, self.ts = spark, path.rstrip("/"), delay, ts

    def store(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stamp = F.unix_millis(F.col(self.ts).cast("timestamp"))
        batch.agg(F.max(stamp).alias("latest")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/latest/batch={number}")
        line = self._line(spark, number)
        late = batch.where(F.unix_micros(F.col(self.ts).cast("timestamp")) <= line * 1000) if line is not None else batch.where("false")
        late.write.mode("overwrite").parquet(f"{self.path}/late/batch={number}")

    def _line(self, spark: SparkSession, number: int) -> int | None:
        if number < 2:
            return None
        latest = spark.read.schema("latest long, batch long").option("basePath", f"{self.path}/latest").parquet(f"{self.path}/latest")
        found = latest.where(F.col("batch") <= number - 2).agg(F.max("latest")).first()[0]
        return None if found is None else found - _micros(self.delay) // 1000

    def read(self, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/late/batch=*")


class ExpiringDevices(StatefulProcessor):
    """Counts an id when it is first seen after its waiting time, and forgets it when that time is over.

    ``handleInitialState`` takes ids that were counted before the stream began.
    """

    def __init__(self, ttl: timedelta) -> None:
        self.ttl = _micros(ttl)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_counted", "micros long")

    def _remember(self, micros: int) -> None:
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.last.update((micros,))
        # The first millisecond at which the id counts again.
        self.handle.registerTimer(-(-(micros + self.ttl) // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        stamps = sorted({int(x) for frame in rows for x in frame["micros"] if last is None or x >= last + self.ttl})
        counted: list[int] = []
        for stamp in stamps:
            if last is None or stamp >= last + self.ttl:
                counted.append(stamp)
                last = stamp
        if counted:
            self._remember(last)
            yield pd.DataFrame({"id": [key[0]] * len(counted), "counted_at": pd.to_datetime(counted, unit="us", utc=True)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._remember(int(initialState["micros"].max()))

    def close(self) -> None:
        pass


def count_expiring_devices(
    visits: DataFrame, watermark: str, ttl: timedelta = REMEMBERED_FOR, counted_before: DataFrame | None = None
) -> DataFrame:
    """One row each time an id counts; needs the RocksDB state store.

    ``counted_before`` has ``id`` and ``counted_at`` of a past count, as the batch form gives them; a
    stream that begins there goes on as if it had seen the visits itself.  State holds only ids whose
    waiting time is not over at the watermark.  Visits late by more than the watermark are not counted.
    """
    keyed = (
        valid_visits(visits).select("id", F.col("ts").cast("timestamp").alias("ts"))
        .withWatermark("ts", watermark).withColumn("micros", F.unix_micros("ts")).groupBy("id")
    )
    initial = None
    if counted_before is not None:
        last = counted_before.groupBy("id").agg(F.max(F.unix_micros("counted_at")).alias("micros"))
        initial = last.groupBy("id")
    return keyed.transformWithStateInPandas(
        statefulProcessor=ExpiringDevices(ttl), outputStructType=COUNTED_SCHEMA, outputMode="Append", timeMode="EventTime", initialState=initial,
    )
