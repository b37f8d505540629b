"""Market profiles, choices inside groups, conditional sums, text blocks."""

from pyspark.sql import functions as F

from tallyloom.functions.lines import iso_day, iso_month, render_line, without_separator
from tallyloom.operators.numbering import number_rows
from tallyloom.operators.quality import group_sum_outside
from tallyloom.queries import query, table
from tallyloom.sinks.blocks import block_text

_MARKET = """
SELECT s_name, count(*) AS qt, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total,
  count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) FILTER (WHERE l_linestatus = 'O') AS open,
  strftime(min(l_shipdate), '%Y-%m-%d') AS first_day, strftime(max(l_shipdate), '%Y-%m-%d') AS last_day
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_name"""


@query("supplier_market", f"""
SELECT *, concat_ws(';', replace(s_name, '#', ','), qt, total, returned, open, first_day, last_day) AS linha,
  row_number() OVER (ORDER BY qt DESC, s_name) AS nr_ordem FROM ({_MARKET})""")
def supplier_market(spark, sf_dir):
    line, supplier = (table(spark, sf_dir, n) for n in ("lineitem", "supplier"))
    # Rows collapse per supplier before names are attached.
    per_supplier = line.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("qt"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("l_linestatus") == "O").alias("open"),
        iso_day(F.min("l_shipdate")).alias("first_day"), iso_day(F.max("l_shipdate")).alias("last_day"),
    )
    market = per_supplier.join(supplier, per_supplier.l_suppkey == supplier.s_suppkey).select(
        "s_name", "qt", "total", "returned", "open", "first_day", "last_day"
    )
    fields = [without_separator(F.col("s_name"), "#"), *[F.col(c) for c in market.columns[1:]]]
    return number_rows(
        market.withColumn("linha", render_line(*fields)), [F.desc("qt"), F.asc("s_name")]
    )


@query("supplier_market_by_month", """
SELECT strftime(l_shipdate, '%Y-%m') AS ano_mes, l_suppkey, count(*) AS qt,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM lineitem GROUP BY 1, 2""")
def supplier_market_by_month(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return line.groupBy(iso_month(F.col("l_shipdate")).alias("ano_mes"), "l_suppkey").agg(
        F.count(F.lit(1)).alias("qt"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"),
    )


@query("order_profiles", """
SELECT o_custkey, count(*) AS qt, CAST(min(o_orderdate) AS DATE) AS first_day,
  CAST(max(o_orderdate) AS DATE) AS last_day, CAST(max(o_totalprice) AS DECIMAL(18,2)) AS largest,
  string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities
FROM orders GROUP BY o_custkey""")
def order_profiles(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("qt"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.max("o_totalprice").cast("decimal(18,2)").alias("largest"),
        # at most five different priorities exist
        F.array_join(F.sort_array(F.collect_set("o_orderpriority")), ",").alias("priorities"),
    )


@query("day_means", """
SELECT CAST(ts AS DATE) AS day, user_id, CAST((2 * CAST(sum(CAST(value AS DECIMAL(18,2))) * 100 AS HUGEINT) + count(*))
  // (2 * count(*)) AS DOUBLE) / 100 AS mean FROM events GROUP BY 1, 2""")
def day_means(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.to_date("ts").alias("day"), "user_id").agg(
        F.round(F.avg(F.col("value").cast("decimal(18,2)")), 2).cast("double").alias("mean")
    )


@query("leader_and_runner_up", """
WITH s AS (SELECT user_id, event_type, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY v DESC, event_type DESC) AS a,
  row_number() OVER (PARTITION BY user_id ORDER BY v, event_type) AS b FROM s)
SELECT user_id, max(event_type) FILTER (WHERE a = 1) AS leader, CAST(max(v) AS DECIMAL(28,2)) AS lead_share,
  max(event_type) FILTER (WHERE b = 1) AS trailer, CAST(min(v) AS DECIMAL(28,2)) AS trail_share
FROM r GROUP BY user_id""")
def leader_and_runner_up(spark, sf_dir):
    sums = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("v")
    )
    side = F.struct("v", F.col("event_type").alias("nm"))
    return sums.groupBy("user_id").agg(F.max(side).alias("hi"), F.min(side).alias("lo")).select(
        "user_id", F.col("hi.nm").alias("leader"), F.col("hi.v").alias("lead_share"),
        F.col("lo.nm").alias("trailer"), F.col("lo.v").alias("trail_share"),
    )


@query("two_answer_profiles", """
WITH p AS (SELECT user_id, CAST(ts AS DATE) AS day, count(DISTINCT event_type) FILTER (WHERE event_type <> 'error') AS n
  FROM events GROUP BY 1, 2),
u AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS undecided
  FROM events WHERE event_type = 'error' GROUP BY 1, 2)
SELECT p.user_id, p.day, n, undecided FROM p LEFT JOIN u ON u.user_id = p.user_id AND u.day = p.day WHERE n = 2 OR n >= 3""")
def two_answer_profiles(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    shown = events.groupBy("user_id", "day", "event_type").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("v")
    )
    answered = F.col("event_type") != "error"
    profile = shown.groupBy("user_id", "day").agg(F.count_if(answered).alias("n"))
    undecided = shown.filter(~answered).select("user_id", "day", F.col("v").alias("undecided"))
    wanted = profile.filter((F.col("n") == 2) | (F.col("n") >= 3))
    return wanted.join(undecided, ["user_id", "day"], "left")


@query("sums_outside_band", """
SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS pc_soma
FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) NOT BETWEEN 90 AND 110""")
def sums_outside_band(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("decimal(18,2)"))
    return group_sum_outside(["l_orderkey"], "q", 90, 110)(line)


@query("month_nation_block", """
WITH m AS (SELECT concat_ws(';', strftime(o_orderdate, '%Y-%m'), n_name, count(*),
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2))) AS linha
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  GROUP BY strftime(o_orderdate, '%Y-%m'), n_name)
SELECT string_agg(linha, chr(10) ORDER BY linha) AS block FROM m""")
def month_nation_block(spark, sf_dir):
    orders, customer, nation = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    homes = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    market = (
        orders.join(homes, orders.o_custkey == homes.c_custkey)
        .groupBy(iso_month(F.col("o_orderdate")).alias("ano_mes"), "n_name")
        .agg(F.count(F.lit(1)).alias("qt"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    )
    lines = market.select(render_line(*[F.col(c) for c in market.columns]).alias("linha"))
    # One line per month and nation: bounded by the calendar and a fixed list.
    return block_text(number_rows(lines, [F.asc("linha")]), "block")
