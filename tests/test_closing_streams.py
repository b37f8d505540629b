"""Streams that close: what is counted and what is late make up all visits; state shrinks again."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.session import scratch_path
from tallyloom.streaming.closing import LateVisits, closed_days, count_expiring_devices
from tallyloom.streaming.visits import ROCKSDB_PROVIDER, STATE_STORE_SETTING, count_devices_batch

START = datetime.datetime(2024, 1, 1)


def at(hours):
    return START + datetime.timedelta(hours=hours)


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(STATE_STORE_SETTING)
    spark.conf.set(STATE_STORE_SETTING, ROCKSDB_PROVIDER)
    yield spark
    spark.conf.set(STATE_STORE_SETTING, before)


def files(spark, batches, schema):
    path = scratch_path(spark, "closing-files")
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/n={number:02d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/n=*")


def drained(stream, spark, store=None):
    """Rows in order of micro-batches, and the state's rows after each."""
    rows = []
    keep = store or (lambda batch, number: rows.extend(batch.collect()))
    query = (
        stream.writeStream.foreachBatch(keep).outputMode("append").option("checkpointLocation", scratch_path(spark, "closing"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return rows, [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress]


def test_counted_and_late_visits_make_up_all(rocksdb):
    spark, rng = rocksdb, random.Random(4)
    batches, n = [], 0
    for k in range(7):
        rows = []
        for _ in range(60):
            rows.append((n, at(30 * k + rng.uniform(0, 30) - rng.choice([0, 0, 0, 40, 70, 100]))))
            n += 1
        batches.append(rows + rng.sample(rows, 10))
    batches += [[(n, at(2000))], [(n + 1, at(2100))], [(n + 2, at(2200))]]
    schema = "visit_id long, ts timestamp"
    late = LateVisits(spark, scratch_path(spark, "late-test"), datetime.timedelta(hours=48))
    drained(files(spark, batches, schema), spark, late.store)
    left_out = {r.visit_id for r in late.read(spark.createDataFrame([], schema).schema).collect()}
    assert 10 < len(left_out) < n / 2
    rows, state = drained(closed_days(files(spark, batches, schema), "48 hours"), spark)
    got = {r.day: r.visits for r in rows}
    assert len(got) == len(rows)
    want = {}
    for rows_ in batches[:7]:
        for i, ts in set(rows_):
            if i not in left_out:
                want[ts.date()] = want.get(ts.date(), 0) + 1
    assert {d: v for d, v in got.items() if d < at(1500).date()} == want
    assert state[-1] < max(state) / 3


def test_ids_expire_and_history_goes_on(rocksdb):
    spark, rng, ttl = rocksdb, random.Random(6), datetime.timedelta(hours=50)
    visits = sorted(((f"device-{rng.randrange(40):04d}", at(rng.uniform(0, 400))) for _ in range(900)), key=lambda r: r[1])
    schema = "id string, ts timestamp"
    cut = 300
    batches = [visits[cut + 100 * k : cut + 100 * (k + 1)] for k in range(6)] + [[("device-last", at(9000))], [("device-last", at(9010))]]
    past = count_devices_batch(spark.createDataFrame(visits[:cut], schema), ttl)
    rows, state = drained(count_expiring_devices(files(spark, batches, schema), "1 hour", ttl, past), spark)
    whole = count_devices_batch(spark.createDataFrame([v for b in [visits[:cut], *batches] for v in b], schema), ttl)
    got = {(r.id, r.counted_at) for r in past.collect()} | {(r.id, r.counted_at) for r in rows}
    assert got == {(r.id, r.counted_at) for r in whole.collect()}
    assert max(state) >= 40 and state[-1] <= 4
    assert whole.where(F.col("id") == "device-last").count() == 1
