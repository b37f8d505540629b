"""Periodic runs of words: stretches that repeat with a period and cannot be made longer.

A run has smallest period q, at least ``4 * q`` words, and neighbours that break the period.  Runs are
found with string synchronising sets at dyadic scales t = 1, 2, 4, ...; scale t answers for the periods
t to 2t - 1:

* A position i is in the set of scale t when the smallest hash of the t-word windows that start at
  i .. i + t is that of the window at i or at i + t.  Whether it is depends on the 2t words from i only,
  so equal contexts are chosen alike.  Windows inside a run of a period of t / 4 or less take no part.
* A run of a period of the scale holds no 3t - 1 words of such a small period, so each t consecutive
  places of it have a chosen one.  Its first one, s, comes back at s + q with the same 2t words, and not
  before: those words would have a smaller period.  Neighbouring chosen positions of equal context thus
  propose every period of the scale, and a proposal is extended word by word in both directions.
* Regions of small periods, left out at scale t, were found at the scales before; scale 1 compares
  neighbouring words.

Every run reported is checked word by word.  Hashes of 64 bits only choose and pair positions.

Texts are independent of each other, so nothing is shuffled.  A task takes a batch of texts, puts texts
of about the same length next to each other, parted by words of their own, and handles ``CHUNK`` words
at a time as arrays: memory follows the chunk or the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyloom.llm.registry import query, table

CHUNK = 1 << 18
REPEATS, LEAST_WORDS = 4, 6
_NONE = np.uint64(2**64 - 1)

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
_ARROW_RUN = pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits, scattered one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _doubled(hashes: np.ndarray, t: int) -> np.ndarray:
    """Hashes of windows of 2t words from those of t words."""
    left, right = hashes[:-t], hashes[t:]
    return _mixed(left * np.uint64(0x9E3779B97F4A7C15) + ((right << np.uint64(23)) | (right >> np.uint64(41))))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, _NONE)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _equal_ahead(words: np.ndarray, at: int, period: int) -> int:
    """The first place from ``at`` whose word differs from the one a period later."""
    step, end = 64, len(words) - period
    while at < end:
        differs = words[at : min(end, at + step)] != words[at + period : min(end, at + step) + period]
        first = int(differs.argmax())
        if differs[first]:
            return at + first
        at, step = at + len(differs), step * 2
    return end


def _equal_behind(words: np.ndarray, at: int, period: int) -> int:
    """The first place of the stretch before ``at`` that equals the words a period later."""
    step = 64
    while at > 0:
        low = max(0, at - step)
        differs = (words[low:at] != words[low + period : at + period])[::-1]
        first = int(differs.argmax())
        if differs[first]:
            return at - first
        at, step = low, step * 2
    return 0


class _Found:
    """Runs of at least four periods; an interval keeps the smallest period, which comes first."""

    def __init__(self) -> None:
        self.periods: dict[tuple[int, int], int] = {}

    def small(self, n: int, t: int) -> np.ndarray | None:
        """Marks windows of t words that lie in a run of a period of t / 4 or less."""
        runs = [(a, b - t + 1) for (a, b), p in self.periods.items() if REPEATS * p <= t <= b - a]
        if not runs:
            return None
        change = np.zeros(n + 2, dtype=np.int64)
        starts, ends = np.array(runs).T
        np.add.at(change, starts, 1)
        np.add.at(change, ends, -1)
        return np.cumsum(change)[: n - t + 1] > 0


def _of_one_word(words: np.ndarray, found: _Found) -> None:
    same = np.flatnonzero(words[1:] == words[:-1])
    if len(same):
        breaks = np.flatnonzero(np.diff(same) != 1)
        firsts, lasts = same[np.r_[0, breaks + 1]], same[np.r_[breaks, len(same) - 1]]
        for a, b in zip(firsts.tolist(), lasts.tolist()):
            if b + 2 - a >= REPEATS:
                found.periods[a, b + 2] = 1


def runs_in(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """Runs as (start, end, period) in an array of word numbers.

    The array may hold several texts, each followed by a number that occurs nowhere else; ``longest``
    is the number of words of the longest text.
    """
    found, n = _Found(), len(words)
    if longest >= REPEATS:
        _of_one_word(words, found)
    t = 1
    hashes = _mixed(words.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    while 2 * t * REPEATS <= longest:
        hashes, t = _doubled(hashes, t), 2 * t
        small = found.small(n, t)
        keys = hashes if small is None else np.where(small, _NONE, hashes)
        least = _least(keys, t + 1)
        chosen = np.flatnonzero(((least == keys[:-t]) | (least == keys[t:])) & (least != _NONE))
        context = _doubled(hashes, t)[chosen]
        order = np.argsort(context, kind="stable")
        s = chosen[order]
        gap = s[1:] - s[:-1]
        pair = np.flatnonzero((context[order][1:] == context[order][:-1]) & (gap >= t) & (gap < 2 * t))
        s, q = s[pair], gap[pair]
        # A run's first chosen position also has its t words two periods on.
        again = s + 2 * q < len(hashes)
        s, q = s[again], q[again]
        again = hashes[s + 2 * q] == hashes[s]
        s, q = s[again], q[again]
        order = np.lexsort((s, q))
        period = stop = -1
        for at, p in zip(s[order].tolist(), q[order].tolist()):
            if p == period and at < stop:
                continue
            period, stop = p, _equal_ahead(words, at, p)
            start, end = _equal_behind(words, at, p), stop + p
            if end - start >= REPEATS * p:
                found.periods.setdefault((start, end), p)
    return [(a, b, p) for (a, b), p in sorted(found.periods.items())]


def runs_of(texts: list[list[bytes]], least: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs as (start, length, period), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    numbers: dict[bytes, int] = {}
    order = sorted((i for i, words in enumerate(texts) if len(words) >= least), key=lambda i: len(texts[i]))

    def handle(part: list[int]) -> None:
        sizes = np.array([len(texts[i]) for i in part])
        offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
        words = np.empty(offsets[-1], dtype=np.int64)
        for k, i in enumerate(part):
            words[offsets[k] : offsets[k + 1] - 1] = [numbers.setdefault(w, len(numbers)) for w in texts[i]]
        words[offsets[1:] - 1] = -1 - np.arange(len(part))
        for a, b, p in runs_in(words, int(sizes.max())):
            if b - a >= least:
                k = int(np.searchsorted(offsets, a, side="right")) - 1
                out[part[k]].append((a - int(offsets[k]), b - a, p))

    part: list[int] = []
    size = 0
    for i in order:
        n = len(texts[i])
        if part and (size + n > CHUNK or n.bit_length() != len(texts[part[0]]).bit_length()):
            handle(part)
            part, size = [], 0
        part.append(i)
        size += n + 1
    if part:
        handle(part)
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without what any run repeats after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, runs, collapsed``.

    ``runs`` lists structs of start, length and period in words, ordered by start, then period.
    ``collapsed`` is the text's words, parted by one space, without repeats.  Null and empty texts have
    no runs and collapse to the empty text.  Repeated rows come out as often as they came in, and
    ``docs`` may hold any other columns.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.split() for text in batch.column("text").to_pylist()]
            runs = runs_of(texts)
            lists = pa.array([[dict(zip(("start", "length", "period"), r)) for r in each] for each in runs], pa.list_(_ARROW_RUN))
            rest = pa.array([collapsed(w, r).decode("utf-8", "replace") for w, r in zip(texts, runs)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, rest], ["doc_id", "runs", "collapsed"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(found, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, with a periodic tail where the id's checksum is divisible by 10.

    With checksum h, n words and g = h / 10, the tail starts at word a = g mod n and repeats its first
    1 + (n - a) / (3 + g mod 8) words.  A null id has no checksum, and its text stays.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when((h % 10 == 0) & (F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")) > 0), _tailed(words, g)).otherwise(text)


def _tailed(words: Column, g: Column) -> Column:
    def tail(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        unit = F.slice(w, a + 1, p)
        whole = F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(whole, F.lit(1), n - a)), " ")

    return F.element_at(F.transform(F.array(words), tail), 1)


SQL = r"""
WITH t AS (
  SELECT [list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
          FOR i IN range(256)] AS crc
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, w, len(w) AS n,
    xor(list_reduce([4294967295::BIGINT] || [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')],
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM t, (SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents)
), g AS (
  SELECT *, h // 10 % n AS a, 1 + (n - h // 10 % n) // (3 + h // 10 % 8) AS p FROM d WHERE n > 0
), v AS (
  SELECT rid, n, CASE WHEN h % 10 = 0 THEN [w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] FOR i IN range(n)] ELSE w END AS w
  FROM g
), x AS (SELECT rid, n, i - 1 AS i, w[i] AS word FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM v)), e AS (
  SELECT a.rid, b.i - a.i AS q, a.i FROM x a JOIN x b ON a.rid = b.rid AND a.word = b.word AND b.i > a.i AND 4 * (b.i - a.i) <= a.n
), s AS (
  SELECT rid, q, min(i) AS b, count(*) + q AS len FROM (
    SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM e
  ) GROUP BY rid, q, island HAVING count(*) >= 3 * q
), r AS (
  SELECT rid, b, len, min(q) AS q FROM s GROUP BY rid, b, len HAVING len >= greatest(6, 4 * min(q))
), o AS (
  SELECT rid, count(*) AS n_runs, max({'len': len, 'b': -b, 'q': -q}) AS top,
    sha256(string_agg(b || ',' || len || ',' || q || chr(10), '' ORDER BY b, q)) AS runs_sha256,
    list({'a': b + q, 'z': b + len}) AS cut
  FROM r GROUP BY rid
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, (-top.b)::BIGINT AS start, top.len::BIGINT AS length,
  (-top.q)::BIGINT AS period, (1000 * top.len // -top.q)::BIGINT AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256,
  sha256(coalesce(array_to_string(CASE WHEN n_runs IS NULL THEN v.w ELSE
    [v.w[i + 1] FOR i IN range(v.n) IF len([c FOR c IN cut IF i >= c.a AND i < c.z]) = 0] END, ' '), '')) AS collapsed_sha256
FROM d LEFT JOIN v USING (rid) LEFT JOIN o USING (rid)
"""


@query("op11_periodic_runs", SQL)
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digest(find_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))))


def digest(found: DataFrame) -> DataFrame:
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
