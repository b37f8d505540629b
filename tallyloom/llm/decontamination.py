"""Benchmark decontamination by winnowing.

The hashes of all K words in a row are taken over the whole text, and of every ``WINDOW - K + 1``
neighbouring hashes the smallest is kept.  Two texts that share ``WINDOW`` words in a row keep the
same hash inside them, so a join of the kept hashes meets every shared window.  A hit is extended to
the windows that hold it, and their words are compared with the items' windows; all words inside equal
windows are hit.  Items shorter than a window are one window: their length is their own K, and every
position of a document is kept for it.

Everything runs in the JVM.  Only narrow (document, place, hash) rows meet the benchmark's hashes,
and texts are read again only for documents with hits.  A document's place is looked at once, however
often its words repeat in it or in an item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.text import ascii_word_count, ascii_words, let, row_name, unused
from tallyloom.session import durable

WINDOW = 10
K = 7
PLACE_BITS = 26
PLACE_MASK = (1 << PLACE_BITS) - 1
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20


def _doubled(values: Column, width: int, join) -> Column:
    """Combine every ``width`` neighbours with ``join``, which may see a value twice, in log steps."""

    def step(by: int):
        return lambda a: F.zip_with(a, F.slice(a, by + 1, F.size(a)), join)

    reach = 1
    while 2 * reach <= width:
        values = let(values, step(reach))
        reach *= 2
    return let(values, step(width - reach)) if reach < width else values


def _first(values: Column, count: Column) -> Column:
    return F.slice(values, 1, F.greatest(F.lit(0), count))


def packed_grams(words: Column, k: int, width: int) -> Column:
    """The hashes of every ``k`` words, of each ``width`` neighbours the smallest, as one number each.

    The high bits hold the hash, the low bits the place counted down, so of equal hashes the
    rightmost is the smallest.  Shorter bits of hash only add candidates; words are compared later.
    """
    size = F.size(words)
    hashes = _doubled(F.transform(words, lambda w: F.xxhash64(w)), k, lambda a, b: F.xxhash64(a, b))
    packed = F.transform(
        _first(hashes, size - k + 1),
        lambda h, i: h.bitwiseAND(~PLACE_MASK).bitwiseOR(F.lit(PLACE_MASK) - i),
    )
    if width == 1:
        return packed
    return F.array_distinct(_first(_doubled(packed, width, lambda a, b: F.least(a, b)), size - k - width + 2))


def _fingerprints(rows: DataFrame, keep: list[str], words: str, short: list[int]) -> DataFrame:
    """``keep``, k, place, hash: winnowed for whole windows, every place for short items' lengths."""
    kinds = [(K, WINDOW - K + 1, WINDOW)] + [(n, 1, n) for n in short]
    parts = [
        rows.select(*keep, F.explode(packed_grams(F.col(words), k, width)).alias("p"), F.lit(length).alias("length"))
        for k, width, length in kinds
    ]
    return reduce(DataFrame.unionByName, parts).select(
        *keep, "length", F.shiftright("p", PLACE_BITS).alias("hash"),
        (F.lit(PLACE_MASK) - F.col("p").bitwiseAND(PLACE_MASK)).cast("int").alias("place"),
    )


def _window(words: str, begin: Column, length: Column) -> Column:
    """Words in a row as one text; no word holds a space."""
    return F.array_join(F.slice(words, begin, length), " ")


def hit_windows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """``doc_id, text_hash, item_id, begin, length``: every window of an item that stands in a document."""
    bench = durable(
        items.select(F.col(item_col).cast("string").alias("item_id"), ascii_words(F.col("text")).alias("i_words"))
        .where(F.size("i_words") > 0).distinct(),
        "benchmark-words",
    )
    lengths = bench.where(F.size("i_words") < WINDOW).select(F.size("i_words").alias("n")).distinct()
    short = sorted(row["n"] for row in lengths.collect())  # at most WINDOW - 1 values
    length = F.least(F.lit(WINDOW), F.size("i_words"))
    sides = _fingerprints(bench.select("i_words", length.alias("i_length")), ["i_length"], "i_words", short)
    sides = durable(
        sides.where("i_length = length").select("i_length", F.col("hash").alias("i_hash")).distinct(), "benchmark-prints"
    )
    sides = F.broadcast(sides) if sides.count() <= BROADCAST_ROWS else sides
    windows = F.transform(F.sequence(F.lit(1), F.size("i_words") - length + 1), lambda i: _window("i_words", i, length))
    known = durable(
        bench.select("item_id", length.alias("i_length"), F.explode(F.array_distinct(windows)).alias("i_window")).distinct(),
        "benchmark-windows",
    )
    held = known.agg(F.sum(F.octet_length("i_window") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + 64)).first()[0] or 0
    known = F.broadcast(known) if held <= BROADCAST_BYTES else known
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        ascii_words(F.col("text")).alias("words"),
    )
    prints = _fingerprints(rows, ["doc_id", "text_hash"], "words", short)
    same = (F.col("hash") == F.col("i_hash")) & (F.col("length") == F.col("i_length"))
    places = durable(
        prints.join(sides, same, "left_semi").select("doc_id", "text_hash", "length", "place").distinct(), "benchmark-places"
    )
    found = places.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("length", "place")).alias("places"))
    found = F.broadcast(found) if places.count() <= BROADCAST_ROWS else found
    texts = docs.select(F.col(id_col).cast("long").alias("d"), F.xxhash64("text").alias("t"), "text")
    near = texts.join(found, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_hash")))
    near = near.select("doc_id", "text_hash", ascii_words(F.col("text")).alias("words"), "places")
    # A window as one number, begin and length, so that distinct ones are found by hash.
    around = F.array_distinct(F.flatten(F.transform("places", lambda p: F.transform(
        F.sequence(F.lit(0), F.when(p["length"] == WINDOW, WINDOW - K).otherwise(0)),
        lambda back: (p["place"] - back).cast("long") * (WINDOW + 1) + p["length"],
    ))))
    near = near.select("doc_id", "text_hash", "words", F.filter(around, lambda w: w >= 0).alias("around"))
    begin, length = (lambda w: F.floor(w / (WINDOW + 1)).cast("int")), (lambda w: (w % (WINDOW + 1)).cast("int"))
    inside = F.filter("around", lambda w: begin(w) + length(w) <= F.size("words"))
    told = F.transform(inside, lambda w: F.struct(
        begin(w).alias("begin"), length(w).alias("length"), _window("words", begin(w) + 1, length(w)).alias("window"),
    ))
    near = near.select("doc_id", "text_hash", F.explode(told).alias("w")).select("doc_id", "text_hash", "w.*")
    equal = (F.col("window") == F.col("i_window")) & (F.col("length") == F.col("i_length"))
    return near.join(known, equal).select("doc_id", "text_hash", "item_id", "begin", "length").distinct()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash``, one row per document.

    Null and empty texts have no words and are clean; so are items without words, and everything if
    either table is empty.  Equal items under several ids count once each.  Rows that repeat share
    their figures.
    """
    windows = durable(hit_windows(docs, items, id_col, item_col), "benchmark-hits")
    hit = (
        windows.select("doc_id", "text_hash", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("length") - 1)).alias("word"))
        .distinct().groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    found = (
        windows.where(F.col("item_id").isNotNull()).groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    keys = ["doc_id", "text_hash"]
    figures = hit.join(found, (hit["doc_id"].eqNullSafe(found["doc_id"])) & (hit["text_hash"] == found["text_hash"]), "left").select(
        *[hit[k].alias(f"f_{k}") for k in keys], "n_hit", "item_ids"
    )
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        ascii_word_count(F.col("text")).alias("n_words"),
    )
    joined = rows.join(figures, rows["doc_id"].eqNullSafe(figures["f_doc_id"]) & (rows["text_hash"] == figures["f_text_hash"]), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "text_hash",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """The documents without any hit, with all their columns."""
    row = unused(docs, "__row")
    hits = hit_windows(docs, items, id_col, item_col)
    hits = hits.select(row_name(F.col("doc_id"), F.col("text_hash")).alias(row)).distinct()
    named = docs.withColumn(row, row_name(F.col(id_col), F.xxhash64("text")))
    return named.join(hits, row, "left_anti").drop(row)


SQL = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM documents
), i AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS s FROM i WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), h AS (
  SELECT doc_id, item_id, s, dw.n FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM h)
  GROUP BY doc_id
), q AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN q USING (doc_id)
"""


@query("op5_decontamination", SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")
