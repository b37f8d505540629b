"""Fingerprints, refresh decisions, reconciliation with state, type-2 history."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tallyloom.operators.changes import (
    reconcile, refresh_if_changed, states_differ, table_fingerprint, values_not_on_file,
)
from tallyloom.operators.history import apply_snapshot, empty_history, publish_history, read_history
from tallyloom.operators.row_changes import changed_rows, publish_state
from tallyloom.queries import query, table
from tallyloom.session import durable, scratch_path

_SLICE_SUMS = ", ".join(
    f"CAST(sum(CAST('0x' || substr(h, {start}, 16) AS UBIGINT)::HUGEINT) AS VARCHAR)"
    for start in (1, 17, 33, 49)
)


@query("orders_fingerprint", f"""
WITH t AS (SELECT unnest([CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), nullif(o_orderstatus, 'P'),
    strftime(o_orderdate, '%Y-%m-%d')]) AS v, generate_subscripts([1, 2, 3, 4], 1) AS nr, o_orderkey FROM orders),
r AS (SELECT sha256(string_agg(coalesce(length(v) || ':' || v, '-'), '' ORDER BY nr)) AS h FROM t GROUP BY o_orderkey)
SELECT sha256(concat_ws('|', CAST(count(*) AS VARCHAR), {_SLICE_SUMS})) AS fingerprint, count(*) AS row_count FROM r""")
def orders_fingerprint(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.to_date("o_orderdate").alias("day"),
    )
    return table_fingerprint(orders)


@query("refresh_decisions", """
SELECT step, rebuilt, CASE WHEN rebuilt THEN n END AS rows_rebuilt FROM (SELECT count(*) AS n FROM customer),
  (VALUES ('1 first', true), ('2 reordered', false), ('3 changed', true)) AS t(step, rebuilt)""")
def refresh_decisions(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    versions = {
        "1 first": customer,
        "2 reordered": customer.repartition("c_mktsegment").sortWithinPartitions(F.desc("c_custkey")),
        "3 changed": customer.withColumn(
            "c_mktsegment", F.when(F.col("c_custkey") == 0, "NEW").otherwise(F.col("c_mktsegment"))
        ),
    }
    state, target = scratch_path(spark, "state"), scratch_path(spark, "rebuilt")
    outcome = []
    for step, (name, version) in enumerate(versions.items()):
        path = f"{target}/{step}"
        rebuilt = refresh_if_changed(
            version, "customer", state, lambda df, path=path: df.write.parquet(path),
            datetime(2024, 1, 1 + step),
        )
        rows = spark.read.parquet(path).count() if rebuilt else None
        outcome.append((name, rebuilt, rows))
    return spark.createDataFrame(outcome, "step string, rebuilt boolean, rows_rebuilt long")


@query("reconciled_documents", """
WITH u AS (SELECT CAST(doc_id AS VARCHAR) AS cid, source || '-' || lang AS doc FROM documents WHERE lang <> 'de'),
f AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS cid, CASE WHEN quality = 0 THEN NULL ELSE x END AS doc
  FROM (SELECT l.doc_id, quality, unnest([source || '-' || lang, 'other']) AS x FROM labels l JOIN documents d ON d.doc_id = l.doc_id)),
p AS (SELECT CAST(doc_id AS VARCHAR) AS cid, DATE '2024-05-01' AS desde FROM labels WHERE toxic = 1)
SELECT cid, status, used_doc, CASE WHEN status = 'changed' THEN coalesce(p.desde, DATE '2024-06-01') END AS desde,
  CASE WHEN status <> 'only_reference' THEN coalesce(n.docs, '') END AS current_docs FROM (
  SELECT coalesce(u.cid, g.cid) AS cid, u.doc AS used_doc, CASE WHEN u.cid IS NULL THEN 'only_current'
    WHEN g.cid IS NULL THEN 'only_reference' WHEN f.cid IS NULL THEN 'changed' END AS status
  FROM u FULL OUTER JOIN (SELECT DISTINCT cid FROM f) g ON g.cid = u.cid LEFT JOIN f ON f.cid = u.cid AND f.doc = u.doc)
LEFT JOIN p USING (cid) LEFT JOIN (SELECT cid, string_agg(DISTINCT doc, ',' ORDER BY doc) AS docs FROM f GROUP BY cid) n USING (cid)
WHERE status IS NOT NULL""")
def reconciled_documents(spark, sf_dir):
    documents, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    name = F.concat_ws("-", "source", "lang")
    reference = documents.filter(F.col("lang") != "de").select(
        F.col("doc_id").cast("string").alias("cid"), name.alias("doc_id")
    )
    known = labels.join(documents.select("doc_id", name.alias("doc")), "doc_id")
    current = known.select(
        F.col("doc_id").cast("string").alias("cid"), "quality",
        F.explode(F.array("doc", F.lit("other"))).alias("doc"),
    ).select("cid", F.when(F.col("quality") != 0, F.col("doc")).alias("doc_id")).distinct()
    previous = labels.filter(F.col("toxic") == 1).select(
        F.col("doc_id").cast("string").alias("cid"),
        F.to_date(F.lit("2024-05-01")).alias("desde"),
    )
    return reconcile(reference, current, previous, date(2024, 6, 1))


@query("reconciliation_changed", """
SELECT CAST(count(*) AS BIGINT) AS open_changes, true AS first_differs, false AS second_differs
FROM labels WHERE quality = 0""")
def reconciliation_changed(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("cid"), "quality")
    reference = labels.select("cid", F.lit("a").alias("doc_id"))
    current = labels.select(
        "cid", F.when(F.col("quality") == 0, "b").otherwise("a").alias("doc_id")
    )
    empty = labels.limit(0).select("cid", F.to_date(F.lit("2024-01-01")).alias("desde"))
    first = durable(reconcile(reference, current, empty, date(2024, 6, 1)))
    again = reconcile(reference, current, first.filter("status = 'changed'"), date(2024, 6, 9))
    return first.agg(F.count_if(F.col("status") == "changed").alias("open_changes")).select(
        "open_changes", F.lit(states_differ(first, first.limit(0))).alias("first_differs"),
        F.lit(states_differ(again, first)).alias("second_differs"),
    )


@query("values_not_on_file", """
SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def unlabelled_documents(spark, sf_dir):
    documents, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    return values_not_on_file(documents.select("doc_id", "source"), labels, ["doc_id"])


_TIMES = (datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1))


@query("customer_history", """
WITH c AS (SELECT c_custkey AS k, c_mktsegment AS s1, c_nationkey = 3 AS late, c_nationkey IN (5, 10, 15) AS gone,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 5000 THEN c_mktsegment ELSE c_mktsegment || '!' END AS s2 FROM customer),
v AS (
  SELECT k, s1 AS segment, TIMESTAMP '2024-01-01' AS f, CASE WHEN gone OR s1 IS DISTINCT FROM s2 THEN TIMESTAMP '2024-02-01' END AS t, false AS d FROM c WHERE NOT late
  UNION ALL SELECT k, s2, TIMESTAMP '2024-02-01', NULL, false FROM c WHERE NOT gone AND (late OR s1 IS DISTINCT FROM s2)
  UNION ALL SELECT k, s1, TIMESTAMP '2024-02-01', TIMESTAMP '2024-03-01', true FROM c WHERE gone AND NOT late
  UNION ALL SELECT k, s2, TIMESTAMP '2024-03-01', NULL, false FROM c WHERE gone)
SELECT k AS c_custkey, segment, f AS valid_from, t AS valid_to, d AS is_deleted,
  sha256(concat_ws('|', CAST(k AS VARCHAR), strftime(f, '%Y-%m-%d %H:%M:%S'))) AS version_id FROM v""")
def customer_history(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    later = F.when(balance >= 5000, F.concat(segment, F.lit("!"))).when(balance >= 0, segment)
    states = (
        customer.filter("c_nationkey <> 3").select("c_custkey", segment.alias("segment")),
        customer.filter("c_nationkey NOT IN (5, 10, 15)").select("c_custkey", later.alias("segment")),
        customer.select("c_custkey", later.alias("segment")),
    )
    history, root = empty_history(states[0]), scratch_path(spark, "history")
    for state, as_of in zip(states, _TIMES):
        publish_history(apply_snapshot(history, state, "c_custkey", ["segment"], as_of), root, as_of)
        history = read_history(spark, root, history.schema)
    return history


@query("order_rows_changed", """
WITH b AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders),
  l AS (SELECT max(day) AS last FROM b)
SELECT 'delete' AS change, 'before' AS side, CAST(1 AS BIGINT) AS copies, b.* FROM b WHERE o_orderstatus = 'P'
UNION ALL SELECT 'edit', 'before', 1, b.* FROM b, l WHERE o_orderstatus <> 'P' AND day = last
UNION ALL SELECT 'edit', 'after', 1, o_orderkey, o_custkey, 'X', day FROM b, l WHERE o_orderstatus <> 'P' AND day = last
UNION ALL SELECT 'insert', 'after', 2, -1 - o_orderkey, o_custkey, o_orderstatus, day FROM b, l
  WHERE o_orderstatus = 'O' AND day = last""")
def order_rows_changed(spark, sf_dir):
    before = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day")
    )
    last = before.agg(F.max("day").alias("last")).first()["last"]
    on_last = F.col("day") == F.lit(last)
    added = before.filter(on_last & (F.col("o_orderstatus") == "O")).withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    edited = before.filter("o_orderstatus <> 'P'").withColumn(
        "o_orderstatus", F.when(on_last, "X").otherwise(F.col("o_orderstatus"))
    )
    paths = [scratch_path(spark, name) for name in ("orders-before", "orders-after")]
    for state, path in zip((before, edited.union(added).union(added)), paths):
        publish_state(state, path, ["o_orderkey"])
    return changed_rows(spark, *paths).select("change", "side", "copies", "row.*")
