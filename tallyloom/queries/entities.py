"""Canonical spellings, lookups by name, content keys."""

from pyspark.sql import functions as F

from tallyloom.operators.entity import (
    canonical_spellings, lookup_by_name_key, most_used_per_key, with_canonical,
)
from tallyloom.operators.joins import lookup_join
from tallyloom.operators.keys import content_key, member_set_key
from tallyloom.queries import query, table

_SPELLING = """CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '/')
  WHEN 2 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) ELSE p_name END"""
_KEY = """array_to_string(list_sort(list_filter(string_split(
  lower(regexp_replace({0}, '[^A-Za-z0-9À-ÿ]', ' ', 'g')), ' '), lambda w: w <> '')), '|')"""


@query("canonical_spellings", f"""
WITH s AS (SELECT p_partkey, {_SPELLING} AS name FROM part),
c AS (SELECT name, {_KEY.format("name")} AS k, count(*) AS n FROM s GROUP BY 1, 2),
f AS (SELECT name, first_value(name) OVER (PARTITION BY k ORDER BY n DESC, name) AS canonical FROM c)
SELECT p_partkey, name, canonical FROM s JOIN f USING (name)""")
def canonical_part_names(spark, sf_dir):
    named = table(spark, sf_dir, "part").select("p_partkey", F.expr(_SPELLING).alias("name"))
    return with_canonical(named, "name", canonical_spellings(named, "name"), "canonical")


@query("lookup_by_name_key", f"""
WITH s AS (SELECT p_partkey, {_SPELLING} AS name FROM part),
l AS (SELECT k, min(t) AS mapped FROM (
  SELECT {_KEY.format("n")} AS k, first_value(t) OVER (PARTITION BY {_KEY.format("n")} ORDER BY n, t) AS t
  FROM (SELECT DISTINCT p_name AS n, 'std ' || p_name AS t FROM part WHERE p_name LIKE '%bolt%')) GROUP BY k)
SELECT p_partkey, name, coalesce(mapped, name) AS mapped FROM s LEFT JOIN l ON k = {_KEY.format("name")}""")
def part_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    named = part.select("p_partkey", F.expr(_SPELLING).alias("name"))
    lookup = part.filter(F.col("p_name").contains("bolt")).select(
        F.col("p_name").alias("n"), F.concat(F.lit("std "), "p_name").alias("t")
    ).distinct()
    return lookup_by_name_key(named, "name", lookup, "n", "t", "mapped").withColumn(
        "mapped", F.coalesce("mapped", "name")
    )


@query("case_insensitive_lookup", """
SELECT c_custkey, coalesce(r_name, n) AS region FROM (
  SELECT c_custkey, CASE WHEN n_regionkey < 4 THEN CASE n_regionkey WHEN 0 THEN 'Africa'
    WHEN 1 THEN 'america' WHEN 2 THEN 'ASIA' ELSE 'Europe' END ELSE n_name END AS n
  FROM customer JOIN nation ON n_nationkey = c_nationkey) LEFT JOIN region ON lower(r_name) = lower(n)""")
def case_insensitive_lookup(spark, sf_dir):
    customer, nation, region = (table(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    written = F.expr("""CASE WHEN n_regionkey < 4 THEN CASE n_regionkey WHEN 0 THEN 'Africa'
      WHEN 1 THEN 'america' WHEN 2 THEN 'ASIA' ELSE 'Europe' END ELSE n_name END""")
    named = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", written.alias("n"), F.lower(written).alias("k")
    )
    lookup = region.select(F.lower("r_name").alias("rk"), "r_name")
    return lookup_join(named, lookup, {"k": "rk"}).select(
        "c_custkey", F.coalesce("r_name", "n").alias("region")
    )


@query("composite_lookup", """
WITH m AS (SELECT n_name AS nation, CASE WHEN n_nationkey % 3 > 0 THEN 'BUILDING' END AS segment,
  'std ' || n_name AS standard, n_nationkey % 2 = 0 AS review FROM nation)
SELECT c_custkey, coalesce(standard, n_name) AS name, coalesce(review, c_mktsegment <> 'MACHINERY') AS review
FROM customer JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN m ON m.nation = n_name AND m.segment = nullif(c_mktsegment, 'FURNITURE')""")
def composite_lookup(spark, sf_dir):
    customer, nation = (table(spark, sf_dir, n) for n in ("customer", "nation"))
    number = F.col("n_nationkey")
    lookup = nation.select(
        F.col("n_name").alias("nation"), F.when(number % 3 > 0, "BUILDING").alias("segment"),
        F.concat(F.lit("std "), "n_name").alias("standard"), (number % 2 == 0).alias("review"),
    )
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", "n_name", "c_mktsegment",
        F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("party"),
    )
    return lookup_join(rows, lookup, {"n_name": "nation", "party": "segment"}).select(
        "c_custkey", F.coalesce("standard", "n_name").alias("name"),
        F.coalesce(F.col("review"), F.col("c_mktsegment") != "MACHINERY").alias("review"),
    )


@query("most_used_names", """
WITH g AS (SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS n, min(l_shipdate) AS a, max(l_shipdate) AS b
  FROM lineitem GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag, l_linestatus) AS rn FROM g),
t AS (SELECT l_suppkey, CAST(sum(n) AS BIGINT) AS qt, CAST(min(a) AS DATE) AS dt_first, CAST(max(b) AS DATE) AS dt_last FROM g GROUP BY 1)
SELECT l_suppkey, l_returnflag, l_linestatus, qt, dt_first, dt_last FROM r JOIN t USING (l_suppkey) WHERE rn = 1""")
def most_used_names(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    return most_used_per_key(line, "l_suppkey", ["l_returnflag", "l_linestatus"], "day")


@query("content_keys", """
SELECT o_orderkey, sha256(concat_ws('|', o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END,
  strftime(o_orderdate, '%Y-%m-%d'))) AS plain,
  sha256(concat_ws('|', o_orderpriority, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '?'),
  strftime(o_orderdate, '%Y-%m-%d'))) AS marked FROM orders""")
def content_keys(spark, sf_dir):
    parts = [
        F.col("o_orderpriority"), F.nullif("o_orderstatus", F.lit("P")), F.to_date("o_orderdate")
    ]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", content_key(*parts).alias("plain"),
        content_key(*parts, null_marker="?").alias("marked"),
    )


@query("member_set_keys", """
WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, nullif(event_type, 'error') AS label FROM events),
s AS (SELECT user_id, day, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS members FROM e GROUP BY 1, 2)
SELECT event_id, sha256(CAST(e.user_id AS VARCHAR) || '|' || members) AS set_key
FROM e JOIN s ON s.user_id = e.user_id AND s.day = e.day""")
def member_set_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("poll"), F.to_date("ts").alias("day"),
        F.nullif("event_type", F.lit("error")).alias("label"),
    )
    keyed = member_set_key(events, ["poll", "day"], "label", "poll", "set_key")
    return keyed.select("event_id", "set_key")
