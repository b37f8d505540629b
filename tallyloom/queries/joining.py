"""Joins: unlisted members, mirrors, reconciliation, record linkage, one-row relations."""

from pyspark.sql import functions as F

from tallyloom.operators.joins import count_unlisted, reconcile_keys, without_mirrored
from tallyloom.operators.linkage import best_links, match_names
from tallyloom.queries import query, table


@query("unlisted_priorities", """
SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus <> 'P') AS considered,
  count(*) FILTER (WHERE o_orderstatus <> 'P' AND p IS NOT NULL
    AND p NOT IN ('1-URGENT', '2-HIGH')) AS unlisted
FROM (SELECT *, nullif(o_orderpriority, '5-LOW') AS p FROM orders) GROUP BY o_custkey""")
def unlisted_priorities(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "p", F.nullif("o_orderpriority", F.lit("5-LOW"))
    )
    listed = orders.filter(F.col("p").isin("1-URGENT", "2-HIGH")).select("p").distinct()
    relevant = F.col("o_orderstatus") != "P"
    return count_unlisted(orders, ["o_custkey"], "p", listed, "p", relevant, considered=relevant)


@query("without_mirrored_orders", """
SELECT o_orderkey FROM orders r WHERE o_orderstatus = 'O' AND NOT EXISTS (
  SELECT 1 FROM orders e WHERE e.o_orderstatus <> 'O' AND e.o_custkey = r.o_custkey
    AND date_trunc('month', e.o_orderdate) = date_trunc('month', r.o_orderdate)
    AND nullif(e.o_orderpriority, '5-LOW') = nullif(r.o_orderpriority, '5-LOW'))""")
def without_mirrored_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_custkey",
        F.trunc(F.to_date("o_orderdate"), "month").alias("month"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )
    own = orders.filter(F.col("o_orderstatus") == "O")
    others = orders.filter(F.col("o_orderstatus") != "O")
    return without_mirrored(own, others, ["o_custkey", "month", "priority"]).select("o_orderkey")


@query("reconciled_customers", """
WITH a AS (SELECT c_custkey AS k, c_mktsegment AS s FROM customer WHERE c_nationkey <> 3),
b AS (SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN 'moved' ELSE c_mktsegment END AS s
  FROM customer WHERE c_nationkey <> 5)
SELECT coalesce(a.k, b.k) AS c_custkey, CASE WHEN b.k IS NULL THEN 'only_left'
  WHEN a.k IS NULL THEN 'only_right' WHEN a.s = b.s THEN 'same' ELSE 'changed' END AS status,
  a.s AS left_segment, b.s AS right_segment
FROM a FULL OUTER JOIN b ON a.k = b.k""")
def reconciled_customers(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    before = customer.filter(F.col("c_nationkey") != 3).select(
        "c_custkey", F.col("c_mktsegment").alias("segment")
    )
    after = customer.filter(F.col("c_nationkey") != 5).select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, "moved").otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    return reconcile_keys(before, after, "c_custkey", ["segment"])


_LINK_SOURCES = """
c AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, n_name, c_mktsegment,
    CAST(floor(o_totalprice / 100) AS INTEGER) AS n
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
l AS (SELECT o_orderkey AS left_id, CASE WHEN o_orderkey % 3 = 0
    THEN lower(c_mktsegment) || '|' || lower(replace(n_name, '_', '')) || 'x' ELSE lower(c_mktsegment) END AS pattern,
    CASE WHEN o_orderkey % 10 <> 9 THEN d - CAST(o_orderkey % 3 AS INTEGER) END AS s, d AS e,
    CASE WHEN o_orderkey % 8 <> 7 THEN n END AS n FROM c),
r AS (SELECT o_orderkey + 1000000 AS right_id,
    'inst' || lower(c_mktsegment) || lower(replace(n_name, '_', '')) || 'x' AS name,
    CASE WHEN o_orderkey % 12 <> 11 THEN d - CAST(o_custkey % 4 AS INTEGER) END AS s,
    d + CAST(o_orderkey % 5 AS INTEGER) - 2 AS e,
    CASE WHEN o_custkey % 9 <> 8 THEN CAST(n * (100 + o_custkey % 7 - 3) AS INTEGER) END AS n FROM c)"""


@query("record_linkage", f"""
WITH {_LINK_SOURCES.replace("CAST(n * (100 + o_custkey % 7 - 3) AS INTEGER)", "CAST(n * (100 + o_custkey % 7 - 3) // 100 AS INTEGER)")},
p AS (
  SELECT left_id, right_id, abs(l.s - r.s) + abs(l.e - r.e) + CASE WHEN abs(l.n - r.n) * 100
    <= greatest(5000, 5 * r.n) THEN 0 ELSE 4 END AS distance
  FROM l JOIN r ON r.e BETWEEN l.e - 3 AND l.e + 3 AND (abs(coalesce(l.s, l.e) - r.s) <= 3
    OR (abs(l.e - r.e) <= 1 AND abs(l.n - r.n) * 100 <= greatest(2000, r.n)))
    AND regexp_matches(r.name, l.pattern)),
k AS (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY distance NULLS FIRST, right_id) AS rn FROM p)
SELECT left_id, right_id, CAST(distance AS INTEGER) AS distance FROM k WHERE rn = 1""")
def record_linkage(spark, sf_dir):
    for name in ("orders", "customer", "nation"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"link_{name}")
    sources = (
        _LINK_SOURCES.replace("FROM orders", "FROM link_orders")
        .replace("JOIN customer", "JOIN link_customer").replace("JOIN nation", "JOIN link_nation")
        .replace("CAST(n * (100 + o_custkey % 7 - 3) AS INTEGER)",
                 "CAST(n * (100 + o_custkey % 7 - 3) DIV 100 AS INTEGER)")
    )
    left = spark.sql(f"WITH {sources} SELECT left_id, pattern, s AS start, e AS `end`, n AS size FROM l")
    right = spark.sql(f"WITH {sources} SELECT right_id, name, s AS start, e AS `end`, n AS size FROM r")
    return best_links(left, right)


@query("regex_name_matches", """
WITH p AS (SELECT DISTINCT CASE n_nationkey % 5 WHEN 0 THEN '^' || substr(n_name, 1, 4) || '.*BUILD' WHEN 1 THEN substr(n_name, 2, 4) || '[A-Z]* +(AUTO|MACH).+[0-4]$'
    WHEN 2 THEN n_name || '|' || substr(n_name, 1, 2) WHEN 3 THEN 'x?' || n_name || ' FURN|HOUSE.*' || n_nationkey || '$' ELSE '9' || n_nationkey || '+$|' || substr(n_name, 1, 5) || '\\w+ \\w+D 7' END AS pattern FROM nation),
m AS (SELECT DISTINCT n_name || ' ' || c_mktsegment || ' ' || (c_custkey % 1000) AS name FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT pattern, name FROM p JOIN m ON regexp_matches(name, pattern)""")
def regex_name_matches(spark, sf_dir):
    """Regexes of many shapes, none of them listed beforehand, against the distinct names."""
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    pattern = F.expr(r"""CASE n_nationkey % 5 WHEN 0 THEN '^' || substr(n_name, 1, 4) || '.*BUILD' WHEN 1 THEN substr(n_name, 2, 4) || '[A-Z]* +(AUTO|MACH).+[0-4]$'
        WHEN 2 THEN n_name || '|' || substr(n_name, 1, 2) WHEN 3 THEN 'x?' || n_name || ' FURN|HOUSE.*' || n_nationkey || '$' ELSE '9' || n_nationkey || '+$|' || substr(n_name, 1, 5) || '\\w+ \\w+D 7' END""")
    named = customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
    names = named.select(F.concat_ws(" ", "n_name", "c_mktsegment", F.pmod("c_custkey", F.lit(1000)).cast("string")).alias("name"))
    return match_names(nation.select(pattern.alias("pattern")), names)


@query("latest_day_orders", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def latest_day_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    latest = orders.agg(F.max("day").alias("day"))
    return orders.join(F.broadcast(latest), "day")


@query("header_scalars", """
SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS loaded,
  (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders) AS recent,
  (SELECT count(*) FROM customer) AS customers FROM events""")
def header_scalars(spark, sf_dir):
    orders, customer = (table(spark, sf_dir, n) for n in ("orders", "customer"))
    loaded = F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("loaded")
    recent = orders.agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("recent"))
    customers = customer.agg(F.count(F.lit(1)).alias("customers"))
    return table(spark, sf_dir, "events").agg(loaded).select(
        "loaded", recent.scalar().alias("recent"), customers.scalar().alias("customers")
    )
