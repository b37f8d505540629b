"""Mixing sources to target weights by weighted sampling without replacement.

Each document draws an exponential key divided by its quality weight; the smallest keys are a
weighted sample (Efraimidis and Spirakis).  A source whose target exceeds its size is first taken
whole as often as it fits, and only the rest is chosen by key, up to the word.

Running sums over a source that holds a third of all rows would gather in one task.  A source with
n rows is therefore cut into about sqrt(n) bins of neighbouring keys: sums of bins run per source,
and rows run only within their bin, so no group has many more than sqrt(n) members.
Rows alike share one key and would share one bin whatever their number: they are one row with a
count until the words of a source are given out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.text import row_name, unused, word_count
from tallyloom.session import durable

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
UNIT_BITS = 48
BROADCAST_ROWS = 100_000
# Copies of one row that a task writes out; larger groups are dealt out to tasks in such parts.
COPIES_PER_TASK = 10_000


def quality_weights(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Weight per labelled id: from 1 (low) to 4 (high); several labels are averaged."""
    return (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("__labelled"))
        .agg(F.avg(F.col("quality").cast("double")).alias("__quality"))
        .select("__labelled", (1 + 3 * F.coalesce("__quality", F.lit(0.5))).alias("__weight"))
    )


def unit_draw(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    head = F.conv(F.substring(digest, 1, UNIT_BITS // 4), 16, 10).cast("double")
    return (head + 0.5) / float(1 << UNIT_BITS)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """Word targets: one row per source in, ``target`` added.

    Sources in code-point order, null last, take the weights in turn.  A target stops at ``cap``
    times its source's size and the excess is shared anew by weight.  Sharing anew ends where one
    rate times the weight, capped, uses all words; sources are capped in the order of size over
    weight, so the rate follows from running sums.  Only sources meet here, one row each.
    """
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    shares = sizes.withColumn("__share", F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1))
    fill = cap * F.col("source_size") / F.col("__share")
    by_fill = Window.orderBy(fill, F.col("source").isNull(), "source")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everywhere = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everywhere) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rated = shares.withColumns({"__rate": left / F.sum("__share").over(onward), "__fill": fill})
    # The first source that is not full sets the rate of all that follow.
    free = F.min(F.when(F.col("__rate") < F.col("__fill"), F.struct("__fill", "__rate"))).over(everywhere)
    rate = free["__rate"]
    target = F.least(
        F.coalesce(rate * F.col("__share"), cap * F.col("source_size").cast("double")),
        cap * F.col("source_size").cast("double"),
    )
    return rated.withColumn("target", target).drop("__share", "__rate", "__fill")


def _alike(
    docs: DataFrame,
    labels: DataFrame,
    weights: tuple[int, ...],
    cap: int,
    seed: int,
    id_col: str,
) -> DataFrame:
    """One row per id, size, source and text hash: its ``copies``, target, whole epochs, and the words
    that the copies of all rows before it in key order hold, and those left for key order."""
    weighted = quality_weights(labels)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"),
        F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("text_hash"),
    ).groupBy("doc_id", "size", "source", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    weight = F.coalesce("__weight", F.lit(2.5))
    key = -F.log(unit_draw(F.lit(seed), F.col("doc_id"), F.col("size"), F.col("source"))) / weight
    rows = durable(
        rows.join(weighted, rows["doc_id"] == weighted["__labelled"], "left")
        .select("doc_id", "size", "source", "text_hash", "copies", key.alias("key")),
        "mix-rows",
    )
    words = F.col("size") * F.col("copies")
    sizes = rows.groupBy("source").agg(
        F.sum(words).alias("source_size"), F.count(F.lit(1)).alias("__rows")
    )
    targets = (
        source_targets(sizes, weights, cap)
        .withColumn("__epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("__rest", F.floor(F.col("target") - F.col("__epochs") * F.col("source_size")))
        .withColumn("__bins", F.ceil(F.sqrt("__rows")))
        .withColumn("__source", F.coalesce("source", F.lit("")))
        .withColumn("__none", F.col("source").isNull())
        .drop("source", "__rows")
    )
    targets = durable(targets, "mix-targets")
    targets = F.broadcast(targets) if targets.count() <= BROADCAST_ROWS else targets
    # Keys have about the distribution 1 - exp(-2.5 key), so equal steps of it hold similar numbers.
    place = F.floor((1 - F.exp(-2.5 * F.col("key"))) * F.col("__bins")).cast("long")
    rows = (
        rows.withColumns({"__source": F.coalesce("source", F.lit("")), "__none": F.col("source").isNull()})
        .join(targets, ["__source", "__none"])
        .withColumn("__bin", place)
    )
    earlier = Window.partitionBy("__source", "__none").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (
        rows.groupBy("__source", "__none", "__bin").agg(F.sum(words).alias("__bin_size"))
        .withColumn("__before_bin", F.coalesce(F.sum("__bin_size").over(earlier), F.lit(0)))
        .drop("__bin_size")
    )
    within = (
        Window.partitionBy("__source", "__none", "__bin").orderBy("key", "doc_id", "size", "text_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("__before_bin") + F.coalesce(F.sum(words).over(within), F.lit(0))
    return rows.join(bins, ["__source", "__none", "__bin"]).select(
        "doc_id", "size", "source", "source_size", "target", "text_hash", "copies", "__epochs", "__rest",
        before.alias("__before"),
    )


def _each_copy(rows: DataFrame) -> DataFrame:
    """A row per copy, numbered from 0 in ``__copy``; many copies are written out by many tasks."""
    rows = durable(rows, "mix-alike")
    few = rows.where(F.col("copies") <= COPIES_PER_TASK).withColumn(
        "__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    )
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_PER_TASK).cast("long")))
    last = F.least(F.col("copies"), F.col("__first") + COPIES_PER_TASK) - 1
    many = (
        rows.where(F.col("copies") > COPIES_PER_TASK).withColumn("__first", first)
        .repartition("doc_id", "text_hash", "__first")
        .withColumn("__copy", F.explode(F.sequence(F.col("__first"), last))).drop("__first")
    )
    return few.unionByName(many)


def plan_mix(
    docs: DataFrame,
    labels: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = MAX_EPOCHS,
    seed: int = 1,
    id_col: str = "doc_id",
) -> DataFrame:
    """``doc_id, size, source, source_size, target, taken`` and the row's text hash.

    Whole epochs come first; the rest of the target goes to documents in key order, and the last one
    gives only the words that are still needed, so a source's sum is its target rounded down.  Equal
    keys are settled by id, size and text hash; rows alike in all of them share one key and one
    place.  Null and empty texts have size 0 and give nothing.  An empty table gives no row.
    """
    rows = _each_copy(_alike(docs, labels, weights, cap, seed, id_col))
    before = F.col("__before") + F.col("__copy") * F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("__rest") - before))
    return rows.select(
        "doc_id", "size", "source", "source_size", "target",
        (F.col("__epochs") * F.col("size") + part).cast("long").alias("taken"), "text_hash",
    )


def mix_sources(
    docs: DataFrame,
    labels: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = MAX_EPOCHS,
    seed: int = 1,
    id_col: str = "doc_id",
) -> DataFrame:
    """The documents of the mix with their columns, and ``mix_size, mix_taken`` words.

    Documents of which no word is taken are left out.  ``mix_taken`` over ``mix_size`` says how often
    a document is read, with a last partial reading.  Rows alike in id, source and text come out as often
    as they came in, and share their words evenly, rounded down.
    """
    row, mixed_from, size, taken = (unused(docs, n) for n in ("__row", "__from", "mix_size", "mix_taken"))
    words = F.col("size") * F.col("copies")
    part = F.greatest(F.lit(0), F.least(words, F.col("__rest") - F.col("__before")))
    share = F.floor((F.col("__epochs") * words + part) / F.col("copies")).cast("long")
    chosen = _alike(docs, labels, weights, cap, seed, id_col).select(
        row_name(F.col("doc_id"), F.col("text_hash")).alias(row), F.col("source").alias(mixed_from),
        F.col("size").alias(size), share.alias(taken),
    ).where(F.col(taken) > 0)
    named = docs.withColumn(row, row_name(F.col(id_col), F.xxhash64("text")))
    same_source = named["source"].cast("string").eqNullSafe(chosen[mixed_from])
    joined = named.join(chosen, (named[row] == chosen[row]) & same_source)
    return joined.select(*[named[name] for name in docs.columns], size, taken)


SQL = r"""
WITH d AS (
  SELECT doc_id, source,
    length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'),
                          '[\x20\x09-\x0D]', '', 'g')) AS size
  FROM documents
), l AS (
  SELECT doc_id, 1 + 3 * coalesce(avg(quality), 0.5) AS weight FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), k AS (
  SELECT d.*, -ln((('0x' || substr(md5('1|' || coalesce(d.doc_id::VARCHAR, '-') || '|' || size || '|'
      || coalesce(source, '-')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
    / coalesce(weight, 2.5) AS key
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1] AS share
  FROM d GROUP BY source
), f AS (
  SELECT *, 3 * source_size / share AS fill,
    (sum(source_size) OVER ()
     - 3 * coalesce(sum(source_size) OVER (ORDER BY 3 * source_size / share, source NULLS LAST
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(share) OVER (ORDER BY 3 * source_size / share, source NULLS LAST
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM s
), t AS (
  SELECT source, source_size,
    least(coalesce((SELECT arg_min(rate, fill) FROM f WHERE rate < fill) * share, 3.0 * source_size),
          3.0 * source_size)::DOUBLE AS target
  FROM f
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t
), r AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, epochs,
    floor(target - epochs * source_size)::BIGINT AS rest,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM r
"""


@query("op3_source_mix", SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")
