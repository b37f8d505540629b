"""Data checks, freshness, the gate before publication, stored failures."""

from datetime import datetime

from pyspark.sql import functions as F

from tallyloom.functions.lines import render_line
from tallyloom.operators import quality as Q
from tallyloom.operators.numbering import number_rows
from tallyloom.queries import query, table
from tallyloom.session import scratch_path

_CHECKS_SQL = """
SELECT 'not_null_part' AS "check", 'error' AS severity, count(*) FILTER (WHERE l_linenumber = 7) AS failures FROM lineitem
UNION ALL SELECT 'accepted_values_l_returnflag', 'warn', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
UNION ALL SELECT 'accepted_range_l_discount', 'error', count(*) FILTER (WHERE l_discount < 0.02 OR l_discount > 0.08) FROM lineitem
UNION ALL SELECT 'accepted_range_l_tax', 'error', count(*) FILTER (WHERE l_tax < 0.01) FROM lineitem
UNION ALL SELECT 'expression_ship_after_1995', 'warn', count(*) FILTER (WHERE l_quantity > 10 AND NOT l_shipdate > TIMESTAMP '1996-01-01') FROM lineitem
UNION ALL SELECT 'unique_part', 'error', count(*) FROM (SELECT l_partkey FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique_l_orderkey_l_linenumber', 'warn', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'relationships_l_orderkey', 'error', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 'sum_band', 'warn', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) NOT BETWEEN 90 AND 110)"""


def _line_checks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    shipped = F.col("l_shipdate") > F.lit("1996-01-01").cast("timestamp_ntz")
    return [
        Q.not_null("part"),
        Q.accepted_values("l_returnflag", ["A", "N"], severity=Q.WARN),
        Q.accepted_range("l_discount", 0.02, 0.08),
        Q.accepted_range("l_tax", low=0.01),
        Q.expression_is_true(
            "ship_after_1995", shipped, severity=Q.WARN, where=F.col("l_quantity") > 10
        ),
        Q.unique("part"),
        Q.unique_combination(["l_orderkey", "l_linenumber"], severity=Q.WARN),
        Q.relationships("l_orderkey", orders, "o_orderkey"),
        Q.query_check("sum_band", Q.group_sum_outside(["l_orderkey"], "l_quantity", 90, 110), severity=Q.WARN),
    ]


def _lines(spark, sf_dir):
    part = F.when(F.col("l_linenumber") != 7, F.col("l_partkey"))
    return table(spark, sf_dir, "lineitem").withColumn("part", part)


@query("table_checks", _CHECKS_SQL)
def table_checks(spark, sf_dir):
    return Q.run_checks(_lines(spark, sf_dir), _line_checks(spark, sf_dir))


@query("stored_failures", _CHECKS_SQL.replace(
    ' AS "check", \'error\' AS severity,', ' AS "check",').replace("', 'error', ", "', ").replace("', 'warn', ", "', "))
def stored_failures(spark, sf_dir):
    checks = _line_checks(spark, sf_dir)
    paths = Q.store_failures(_lines(spark, sf_dir), checks, scratch_path(spark, "failures"))
    counts = [
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("check"), "failures"
        )
        for name, path in paths.items()
    ]
    combined = counts[0]
    for more in counts[1:]:
        combined = combined.unionByName(more)
    return combined


@query("source_freshness", """
SELECT name, newest, CASE WHEN newest >= TIMESTAMP '2024-02-03' - INTERVAL 7 DAY THEN 'pass' ELSE 'warn' END AS status FROM (
  SELECT 'events' AS name, max(ts) AS newest FROM events UNION ALL SELECT 'orders', max(o_orderdate) FROM orders)""")
def source_freshness(spark, sf_dir):
    as_of = datetime(2024, 2, 3)
    events = Q.source_freshness(table(spark, sf_dir, "events"), "ts", as_of)
    orders = Q.source_freshness(table(spark, sf_dir, "orders"), "o_orderdate", as_of)
    return events.withColumn("name", F.lit("events")).unionByName(
        orders.withColumn("name", F.lit("orders"))
    )


def _lines_of_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderkey") % 50 == 0, " ").when(
        F.col("o_orderkey") % 70 == 0, F.concat("o_orderpriority", F.lit("[1]"))
    ).otherwise(F.col("o_orderpriority"))
    good = orders.select(render_line(
        F.to_date("o_orderdate"), F.col("o_orderpriority"), F.date_sub("o_orderdate", 2)
    ).alias("linha"))
    bad = orders.select(render_line(F.to_date("o_orderdate"), name, F.lit("`")).alias("linha"))
    return good, bad


@query("block_problems", """
SELECT 'good' AS block, count(*) AS lines, 0::BIGINT AS forbidden, 0::BIGINT AS blank_names, 0::BIGINT AS marked_names, true AS accepted FROM orders
UNION ALL SELECT 'bad', count(*), count(*), count(*) FILTER (WHERE o_orderkey % 50 = 0),
  count(*) FILTER (WHERE o_orderkey % 70 = 0 AND o_orderkey % 50 <> 0), false FROM orders""")
def block_problems(spark, sf_dir):
    good, bad = _lines_of_orders(spark, sf_dir)
    return Q.block_problems(good, "linha", "good", True).unionByName(
        Q.block_problems(bad, "linha", "bad", True)
    )


@query("publication_gate", """
SELECT block, accepted FROM (VALUES ('good', true), ('bad', false), ('empty', false), ('header', true)) t(block, accepted)
WHERE EXISTS (SELECT 1 FROM orders)""")
def publication_gate(spark, sf_dir):
    good, bad = _lines_of_orders(spark, sf_dir)
    header = table(spark, sf_dir, "orders").agg(
        F.to_date(F.max("o_orderdate")).alias("recent"), F.count(F.lit(1)).alias("cadence")
    )
    blocks = {"good": good, "bad": bad, "empty": good.filter(F.length("linha") < 3)}
    return Q.publication_gate(blocks, ["good", "bad"], header, ["recent"], "cadence")


@query("fallback_choice", """
SELECT count(*) AS lines, 0::BIGINT AS forbidden FROM orders""")
def fallback_choice(spark, sf_dir):
    good, bad = _lines_of_orders(spark, sf_dir)

    def failing():
        raise RuntimeError("first computation is not available")

    def accepted(block):
        return Q.block_problems(block, "linha", "b", True).first()["accepted"]

    chosen = Q.first_accepted([failing, lambda: bad, lambda: good], accepted)
    return Q.block_problems(chosen, "linha", "b", True).select("lines", "forbidden")


@query("header_dates", """
WITH l AS (SELECT CAST(o_orderdate AS DATE) AS e, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderdate AS DATE) - CAST(o_orderkey % 6 AS INTEGER) END AS s FROM orders WHERE o_orderstatus <> 'P'),
m AS (SELECT max(e) AS e FROM l)
SELECT strftime(m.e, '%Y-%m-%d') AS campo_recente, strftime(max(coalesce(l.s, l.e)), '%Y-%m-%d') AS campo_inicio FROM l JOIN m ON m.e = l.e GROUP BY m.e""")
def header_dates(spark, sf_dir):
    return Q.header_dates_from_lines(_dated_blocks(table(spark, sf_dir, "orders")))


def _dated_blocks(orders):
    end = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate").cast("string")).otherwise("n/a")
    start = F.when(
        F.col("o_orderkey") % 4 > 0, F.date_sub(F.to_date("o_orderdate"), (F.col("o_orderkey") % 6).cast("int"))
    )
    first = orders.filter(F.col("o_orderpriority") < "3").select(render_line(end, start).alias("linha"))
    second = orders.filter(F.col("o_orderpriority") >= "3").select(
        render_line(end, F.lit("x"), start).alias("linha")
    )
    return [(first, 1), (second, 2)]


@query("header_repaired", """
WITH l AS (SELECT CAST(o_orderdate AS DATE) AS e, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderdate AS DATE) - CAST(o_orderkey % 6 AS INTEGER) END AS s FROM orders WHERE o_orderstatus <> 'P'),
m AS (SELECT max(e) AS e FROM l), d AS (SELECT m.e, max(coalesce(l.s, l.e)) AS s FROM l JOIN m ON m.e = l.e GROUP BY m.e),
h AS (SELECT count(*) AS n, CAST(max(o_orderdate) AS DATE) + 30 AS campo_recente FROM orders)
SELECT n, d.e AS campo_recente, strftime(d.s, '%Y-%m-%d') AS campo_inicio, CASE WHEN h.campo_recente <> d.e THEN 'campo_recente,' ELSE '' END || 'campo_inicio' AS ajustes FROM h, d""")
def header_repaired(spark, sf_dir):
    """A header whose latest date is of no line, and whose start is missing."""
    orders = table(spark, sf_dir, "orders")
    header = orders.agg(
        F.count(F.lit(1)).alias("n"), F.date_add(F.max(F.to_date("o_orderdate")), 30).alias("campo_recente"),
        F.lit(None).cast("string").alias("campo_inicio"),
    )
    return Q.repair_header(header, Q.header_dates_from_lines(_dated_blocks(orders)))


@query("numbering_checks", """
SELECT c AS "check", 'warn' AS severity, 0::BIGINT AS failures FROM (VALUES ('unique_nr_ordem'), ('not_null_nr_ordem'), ('not_null_linha')) t(c)
WHERE EXISTS (SELECT 1 FROM orders)""")
def numbering_checks(spark, sf_dir):
    good, _ = _lines_of_orders(spark, sf_dir)
    numbered = number_rows(good, [F.asc("linha")])
    return Q.run_checks(numbered, [
        Q.unique("nr_ordem", severity=Q.WARN), Q.not_null("nr_ordem", severity=Q.WARN),
        Q.not_null("linha", severity=Q.WARN),
    ])
