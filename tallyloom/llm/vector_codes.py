"""Short codes for vectors: each part of a vector is replaced by the number of a codebook entry.

A vector's components become integers and are cut into equal parts.  Every part position has its own
codebook, which starts as the parts of the vectors with the smallest ids and is moved to the means of
its parts for a few rounds.

Nearest entries are found with fixed pivots (LAESA).  Each part's distances to the pivots of its
position are computed once and stored with it.  In each round only the pivots are compared with the
new entries; ``|d(part, pivot) - d(pivot, entry)|`` is then a lower bound of ``d(part, entry)``.
Entries are tried in the order of their bounds, by exact integers, and a part is done as soon as the
next bound exceeds the best distance found.  The bounds leave room for rounding, so no entry that
could win or tie is ever left out.

Vectors are read where they lie and never shuffled; a task hands on one row per part position and
entry it has used.  The driver sees codebooks only, whose size is set by the parameters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyloom.llm.registry import query, table
from tallyloom.session import durable

PARTS, ENTRIES, ROUNDS, PIVOTS, SCALE = 16, 64, 2, 4, 256
#: Relative room for the rounding of stored distances (four bytes each) and of roots.
ROOM = 2.0**-21


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def _integers(vector: Column, limit: int) -> Column:
    return F.transform(
        vector,
        lambda x: F.greatest(F.lit(-float(limit)), F.least(F.lit(float(limit)), F.floor(x.cast("double") * SCALE).cast("double"))).cast("int"),
    )


def _limit(width: int) -> int:
    """The largest component for which a whole vector's squared distance fits a long."""
    return 2 ** ((61 - max(1, (width - 1).bit_length())) // 2 - 1)


def _pivots(entries: np.ndarray, wanted: int) -> np.ndarray:
    """For each part position, entries that lie far from each other; the first one is entry 0."""
    parts, _, _ = entries.shape
    chosen = [np.zeros(parts, dtype=np.int64)]
    each = np.arange(parts)
    gap = None
    while len(chosen) < wanted:
        away = ((entries - entries[each, chosen[-1]][:, None, :]) ** 2).sum(-1)
        gap = away if gap is None else np.minimum(gap, away)
        chosen.append(gap.argmax(1))
    return np.stack([entries[each, c] for c in chosen], axis=1)


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of parts (rows, positions, width) to the pivots of their positions."""
    return np.stack([np.sqrt(((x - pivots[:, j]) ** 2).sum(-1)) for j in range(pivots.shape[1])], axis=-1)


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each part the nearest entry's number and squared distance, and how many entries were tried.

    ``x`` is (rows, positions, width), ``entries`` (positions, entries, width); ties go to the lower
    number.
    """
    rows, parts, width = x.shape
    k = entries.shape[1]
    between = np.sqrt(((pivots[:, :, None, :] - entries[:, None, :, :]) ** 2).sum(-1))
    low = np.zeros((rows, parts, k))
    for j in range(pivots.shape[1]):
        a, b = to_pivots[:, :, j, None].astype(np.float64), between[None, :, j, :]
        np.maximum(low, np.abs(a - b) - ROOM * (a + b), out=low)
    low = (low * low * (1 - 1e-9)).reshape(-1, k)
    order = np.argsort(low, axis=1, kind="stable")
    flat, position = x.reshape(-1, width), np.tile(np.arange(parts), rows)
    best = np.full(rows * parts, np.iinfo(np.int64).max)
    chosen = np.full(rows * parts, k)
    open_, tried = np.arange(rows * parts), 0
    for step in range(k):
        e = order[open_, step]
        near = low[open_, e] <= best[open_]
        open_, e = open_[near], e[near]
        if not len(open_):
            break
        tried += len(open_)
        away = ((flat[open_] - entries[position[open_], e]) ** 2).sum(-1)
        wins = (away < best[open_]) | ((away == best[open_]) & (e < chosen[open_]))
        best[open_[wins]], chosen[open_[wins]] = away[wins], e[wins]
    return chosen.reshape(rows, parts), best.reshape(rows, parts), tried


def _array(column: pa.Array, *shape: int, kind: type = np.int64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, *shape)


class Codebooks:
    """Codebook entries as integers, (positions, entries, width of a part)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _with_pivot_distances(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    parts, _, width = pivots.shape
    schema = T.StructType(rows.schema.fields + [T.StructField("to_pivots", T.ArrayType(T.FloatType()))])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = _to_pivots(_array(batch.column("ints"), parts, width), pivots).reshape(batch.num_rows, -1)
            listed = pa.FixedSizeListArray.from_arrays(pa.array(away.ravel(), pa.float32()), away.shape[1] or 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, listed.cast(pa.list_(pa.float32()))], [*batch.schema.names, "to_pivots"])

    return rows.mapInArrow(measured, schema)


def _moved(stored: DataFrame, entries: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Entries as the rounded-down means of the parts nearest to them; unused entries stay."""
    parts, k, width = entries.shape
    sums = [f"s{i}" for i in range(width)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, used = np.zeros((parts * k, width), dtype=np.int64), np.zeros(parts * k, dtype=np.int64)
        for batch in batches:
            x = _array(batch.column("ints"), parts, width)
            chosen, _, _ = nearest(x, _array(batch.column("to_pivots"), *pivots.shape[:2], kind=np.float32), entries, pivots)
            cell = (chosen + np.arange(parts) * k).ravel()
            np.add.at(total, cell, x.reshape(-1, width))
            used += np.bincount(cell, minlength=parts * k)
        cells = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(used[cells]), *(pa.array(total[cells, i]) for i in range(width))], ["cell", "n", *sums]
        )

    schema = "cell long, n long, " + ", ".join(f"{s} long" for s in sums)
    found = stored.select("ints", "to_pivots").mapInArrow(partial, schema).groupBy("cell").agg(
        F.sum("n").alias("n"), *(F.sum(F.col(s).cast("decimal(19,0)")).alias(s) for s in sums)
    )
    moved = entries.copy().reshape(parts * k, width)
    for row in found.collect():  # one row per entry in use
        moved[row["cell"]] = [int(row[s]) // row["n"] for s in sums]
    return moved.reshape(parts, k, width)


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    n_entries: int = ENTRIES,
    rounds: int = ROUNDS,
    n_pivots: int = PIVOTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: tuple[str, ...] = ("label",),
) -> tuple[DataFrame, Codebooks]:
    """Stored rows ``vec_id``, ``keep``, ``code`` (array of entry numbers), ``error`` and the codebooks.

    Vectors that are null, empty or hold null or non-finite components are left out, and so are
    vectors whose length differs from that of the smallest usable id or is no multiple of ``parts``
    (a ValueError if that first one isn't).  Integers are held within the bounds that keep a squared
    distance in a long (2^26 for 64 components).  Repeated ids are ordered by their vectors, null ids
    come last, and every row is coded.  An empty table gives no rows and empty codebooks.
    """
    names = [id_col, *(c for c in keep if c in vectors.columns)]
    kept = vectors.select(*names, F.col(vector_col).alias("ints")).where(_usable(F.col("ints")))
    first = F.col(id_col).asc_nulls_last()
    start = kept.select(id_col, "ints").orderBy(first, "ints").limit(1).collect()
    width = len(start[0]["ints"]) if start else parts
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    kept = kept.where(F.size("ints") == width).withColumn("ints", _integers(F.col("ints"), _limit(width)))
    smallest = [r["ints"] for r in kept.select(id_col, "ints").orderBy(first, "ints").limit(n_entries).collect()]
    entries = np.array(smallest, dtype=np.int64).reshape(-1, parts, width // parts).transpose(1, 0, 2)
    out = T.StructType([vectors.schema[c] for c in names] + [
        T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType()),
    ])
    if not smallest:
        return vectors.sparkSession.createDataFrame([], out), Codebooks(entries)
    pivots = _pivots(entries, min(n_pivots, len(smallest)))
    stored = durable(_with_pivot_distances(kept, pivots), "vector-parts")
    for _ in range(rounds):
        entries = _moved(stored, entries, pivots)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _array(batch.column("ints"), parts, width // parts)
            chosen, best, _ = nearest(x, _array(batch.column("to_pivots"), *pivots.shape[:2], kind=np.float32), entries, pivots)
            code = pa.FixedSizeListArray.from_arrays(pa.array(chosen.ravel(), pa.int32()), parts).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), code, pa.array(best.sum(1))], out.names)

    return durable(stored.mapInArrow(coded, out), "vector-codes"), Codebooks(entries)


def with_group_error(coded: DataFrame, group: str = "label", name: str = "label_error") -> DataFrame:
    """``coded`` with the errors of all rows of its group, nulls together.

    Summed first and joined back, so a group of any size is no task of its own.
    """
    most = F.lit(2**63 - 1)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), most.cast("decimal(38,0)")).cast("long")
    sums = coded.groupBy(F.col(group).alias("__group")).agg(total.alias(name))
    return coded.join(sums, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")


def reference_sql(parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """SQL that compares every part with every entry."""
    near = """
a{r} AS (
  SELECT rid, part, min({{'d': list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x.x, c.x)]), 'e': e}}) AS best
  FROM x JOIN c{r} c USING (part) GROUP BY rid, part
)"""
    move = """
m{r} AS (
  SELECT part, e, list(v ORDER BY i) AS x FROM (
    SELECT part, e, i, ((s - (((s % n) + n) % n)) // n)::BIGINT AS v FROM (
      SELECT x.part, best.e AS e, i, sum(x.x[i]) AS s, count(*) AS n
      FROM a{p} a JOIN x USING (rid, part), generate_series(1, len(x.x)) g(i) GROUP BY ALL)
  ) GROUP BY part, e
), c{r} AS (SELECT part, e, coalesce(m.x, c.x) AS x FROM c{p} c LEFT JOIN m{r} m USING (part, e))"""
    steps = [near.format(r=0)]
    for r in range(1, rounds + 1):
        steps += [move.format(r=r, p=r - 1), near.format(r=r)]
    return f"""
WITH k AS (
  SELECT vec_id, label, v, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS rid FROM (
    SELECT vec_id, label, [floor({SCALE} * y)::BIGINT FOR y IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([y FOR y IN embedding IF y IS NULL OR NOT isfinite(y)]) = 0)
), x AS (
  SELECT rid, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS x
  FROM k, generate_series(0, {parts - 1}) g(part)
), c0 AS (SELECT part, rid AS e, x FROM x WHERE rid < {n_entries}), {", ".join(s.strip() for s in steps)}, f AS (
  SELECT rid, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
  FROM a{rounds} GROUP BY rid
), b AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM k JOIN f USING (rid), b
"""


@query("op13_vector_codes", reference_sql())
def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    digits = F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return with_group_error(coded).select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256")
    )
