"""Session settings and durable intermediate results."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan relies on.  The two on skew let adaptive execution split a hot
# partition of a join even when that costs one more shuffle further down.  The JVM never compiles
# a method of more than 8,000 bytes; a stage of many text expressions that would become one runs
# its operators one by one, with methods that are compiled.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# While a result is stored, its exchanges are read by that one job alone.
_DROP_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Paths that were stored since the innermost ``durable_alone`` began; none outside of one.
_stored: ContextVar[list[str] | None] = ContextVar("stored", default=None)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "tallyloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session; leave ``master`` and ``shuffle_partitions`` unset on a cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made up only for a local session that names none, and goes when the
    driver ends.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named is None and current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="tallyloom-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if current is None:
        context.setCheckpointDir(named)
    return named or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _write(df: DataFrame, label: str) -> str:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_DROP_EXCHANGES, None)
    spark.conf.set(_DROP_EXCHANGES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_EXCHANGES)
        else:
            spark.conf.set(_DROP_EXCHANGES, before)
    return path


def durable(df: DataFrame, label: str = "stored") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, so lost executors cannot change a result that depends on layout or order, and
    lets several readers share the work, each with only the columns it needs.  Exchanges of the write
    go when it is done.  The files stay until the folder is cleaned, as checkpoint files do, or the
    ``durable_alone`` around this call ends.
    """
    path = _write(df, label)
    if (stored := _stored.get()) is not None:
        stored.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable_alone(build: Callable[[], DataFrame], label: str = "stored") -> DataFrame:
    """``durable`` of what ``build`` gives, without the results stored on the way.

    Those are removed once the frame is written, so ``build`` must not hand them to anyone else.
    """
    outer = _stored.get()
    token = _stored.set([])
    try:
        df = build()
        path = _write(df, label)
        spent = _stored.get()
    finally:
        _stored.reset(token)
    spark = df.sparkSession
    for old in spent:
        folder = spark._jvm.org.apache.hadoop.fs.Path(old)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    if outer is not None:
        outer.append(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Share out a scan that comes in fewer pieces than there are cores.

    A large input is split by the scan itself and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
