"""Landing of all-string tables."""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

LOAD_TIME_COLUMN = "_ingerido_em"
ROW_ID_COLUMN = "_linha"
# --- fixed values: characters not allowed in a column name, and the name of a nameless one --
INVALID_NAME_CHARACTERS = re.compile(r"[ ,;{}()\n\t=]+")
NAMELESS = "coluna"
# -------------------------------------------------------------------------------------------


def clean_column_names(names: list[str]) -> list[str]:
    """Names a table accepts, made unique regardless of case by a numeric ending."""
    taken: set[str] = set()
    result = []
    for raw in names:
        base = INVALID_NAME_CHARACTERS.sub("_", str(raw).strip()).rstrip("_") or NAMELESS
        candidates = (base if n == 1 else f"{base}_{n}" for n in range(1, len(names) + 2))
        name = next(c for c in candidates if c.upper() not in taken)
        taken.add(name.upper())
        result.append(name)
    return result


def prepare_raw(df: DataFrame) -> DataFrame:
    """Everything text, empty instead of NULL, names cleaned."""
    renamed = df.toDF(*clean_column_names(df.columns))
    return renamed.select(
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in renamed.columns]
    )


def land_table(
    df: DataFrame, root: str, name: str, publish: bool = True, loaded_at: datetime | None = None,
    row_ids: bool = False,
) -> int:
    """Write a table to a new version directory, then point readers at it; returns its rows.

    Rows are counted while they are written.  An empty extract is refused before readers see it.
    ``publish=False`` writes the files and leaves the published version alone.  ``row_ids`` keeps
    a number made of each row's content, the same at every load, so that later choices between
    rows need not read them whole; rows alike in all columns share one.
    """
    loaded_at = loaded_at or datetime.now(timezone.utc)
    spark = df.sparkSession
    observation = Observation()
    version = f"{loaded_at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    path = f"{root.rstrip('/')}/{name}/{version}"
    prepared = prepare_raw(df)
    if row_ids:
        prepared = prepared.withColumn(ROW_ID_COLUMN, F.xxhash64(*prepared.columns))
    stamped = prepared.withColumn(LOAD_TIME_COLUMN, F.lit(loaded_at).cast("timestamp"))
    stamped.observe(observation, F.count(F.lit(1)).alias("rows")).write.option(
        "compression", "snappy"
    ).parquet(path)
    rows = observation.get["rows"]
    if rows == 0:
        raise ValueError(f"{name}: the extract has no rows")
    if publish:
        _versions(spark, root, name, [(version, rows, loaded_at)])
    return rows


_VERSION_SCHEMA = "version string, rows long, loaded_at timestamp"


def _versions(spark: SparkSession, root: str, name: str, entries: list[tuple]) -> None:
    spark.createDataFrame(entries, _VERSION_SCHEMA).coalesce(1).write.mode("append").parquet(
        f"{root.rstrip('/')}/{name}/_published"
    )


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The published version of a raw table."""
    base = f"{root.rstrip('/')}/{name}"
    published = spark.read.schema(_VERSION_SCHEMA).parquet(f"{base}/_published")
    newest = published.agg(F.max_by("version", F.struct("loaded_at", "version")).alias("version"))
    return spark.read.parquet(f"{base}/{newest.first()['version']}")
