"""First rows per key, gaps, running numbers and smoothing."""

from datetime import date

from pyspark.sql import functions as F

from tallyloom.functions.lines import render_line
from tallyloom.operators.joins import attach_group_values
from tallyloom.operators.numbering import number_rows
from tallyloom.operators.quantiles import day_sketches, merged_windows, rank_error, sketch_quantile, typical_gap_of
from tallyloom.operators.stats import smoothed
from tallyloom.operators.windows import (
    day_gaps, first_per_key, moving_average, typical_gap, windows_in_ranges,
)
from tallyloom.queries import query, table
from tallyloom.session import durable


@query("latest_order_per_customer", """
SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END DESC NULLS LAST, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def latest_order_per_customer(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    dated = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    latest = first_per_key(orders, ["o_custkey"], [dated.desc_nulls_last(), F.asc("o_orderkey")])
    return latest.select(
        "o_custkey", "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )


@query("last_event_flags", """
SELECT event_id, ts = max(ts) OVER (PARTITION BY nullif(event_type, 'error')) AS is_last FROM events""")
def last_event_flags(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.nullif("event_type", F.lit("error")).alias("kind")
    )
    flagged = attach_group_values(events, ["kind"], last=F.max("ts"))
    return flagged.select("event_id", (F.col("ts") == F.col("last")).alias("is_last"))


@query("active_day_gaps", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
g AS (SELECT user_id, day, CAST(day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS gap FROM d)
SELECT user_id, greatest(1, coalesce(quantile_disc(gap, 0.5) FILTER (WHERE gap > 0), 7)) AS cadence
FROM g GROUP BY user_id""")
def active_day_gaps(spark, sf_dir):
    days = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    gaps = day_gaps(days, ["user_id"], "day")
    return gaps.groupBy("user_id").agg(typical_gap(F.col("gap"), 7).alias("cadence"))


@query("numbered_orders", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS nr_ordem
FROM orders""")
def numbered_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    numbered = number_rows(
        orders, [F.asc("o_orderpriority"), F.desc("o_totalprice"), F.asc("o_orderkey")]
    )
    return numbered.select("o_orderkey", "nr_ordem")


_LINE = """concat_ws(';', strftime(o_orderdate, '%Y-%m-%d'), o_orderstatus,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), CAST(o_orderkey AS VARCHAR))"""


@query("numbered_lines", f"""
SELECT linha, row_number() OVER (ORDER BY linha) AS nr_ordem FROM (SELECT {_LINE} AS linha FROM orders)""")
def numbered_lines(spark, sf_dir):
    line = render_line(
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")),
        F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderkey"),
    )
    lines = table(spark, sf_dir, "orders").select(line.alias("linha"))
    return number_rows(lines, [F.asc("linha")])


@query("smoothed_series", """
WITH s AS (SELECT event_type, CAST(ts AS DATE) AS day,
  sum(CAST(value AS DECIMAL(18,2))) AS total FROM events
  WHERE event_type <> 'error' OR CAST(ts AS DATE) <= DATE '2024-01-14' GROUP BY 1, 2),
w AS (SELECT *, sum(total) OVER v AS t, count(*) OVER v AS n,
  count(*) OVER (PARTITION BY event_type) AS points FROM s
  WINDOW v AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
SELECT event_type, day, CAST(CASE WHEN points > 14 THEN
  CAST((2 * CAST(t * 10000 AS HUGEINT) + n) // (2 * n) AS DECIMAL(38,4)) / 10000 END AS DECIMAL(18,4)) AS smooth FROM w""")
def smoothed_series(spark, sf_dir):
    day = F.to_date("ts")
    events = table(spark, sf_dir, "events").filter(
        (F.col("event_type") != "error") | (day <= F.to_date(F.lit("2024-01-14")))
    )
    series = events.groupBy("event_type", day.alias("day")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("total")
    )
    return smoothed(series, "day", "event_type", "total", "smooth").select(
        "event_type", "day", F.col("smooth").cast("decimal(18,4)").alias("smooth")
    )


@query("quantity_trend", """
WITH w AS (SELECT l_returnflag, l_orderkey, l_linenumber,
  sum(CAST(l_quantity * 100 AS HUGEINT)) OVER v AS t, count(*) OVER v AS n,
  count(*) OVER (PARTITION BY l_returnflag) AS points FROM lineitem
  WINDOW v AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
    ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING))
SELECT l_returnflag, l_orderkey, l_linenumber, CAST(CASE WHEN points >= 1000 THEN
  CAST((20000 * t + n) // (2 * n) AS DECIMAL(38,6)) / 1000000 END AS DECIMAL(18,6)) AS trend FROM w""")
def quantity_trend(spark, sf_dir):
    """Three series that hold all lines between them, each shared by many tasks."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quantity"]
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "quantity", F.col("l_quantity").cast("decimal(18,2)")
    ).select("l_returnflag", *order)
    smooth = moving_average(
        lines, ["l_returnflag"], order, "quantity", "trend", half_width=50, min_points=1000, range_rows=5000
    )
    return smooth.select(
        "l_returnflag", "l_orderkey", "l_linenumber", F.col("trend").cast("decimal(18,6)").alias("trend")
    )


@query("time_since_event", """
SELECT event_id, CAST(date_diff('second', lag(ts) OVER v, ts) AS BIGINT) AS since_previous,
  CAST(date_diff('second', ts, lead(ts, 3) OVER v) AS BIGINT) AS until_third
FROM (SELECT event_id, event_type, date_trunc('second', ts) AS ts FROM events)
WINDOW v AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def time_since_event(spark, sf_dir):
    """Seconds since the event before and until the third one after, within each type."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.date_trunc("second", "ts").alias("ts"))

    def times(window):
        now = F.unix_seconds(F.col("ts").cast("timestamp"))
        return {
            "since_previous": now - F.lag(now).over(window),
            "until_third": F.lead(now, 3).over(window) - now,
        }

    timed = windows_in_ranges(events, ["event_type"], [F.asc("ts"), F.asc("event_id")], 1, 3, times, 1000)
    return timed.select("event_id", "since_previous", "until_third")


@query("user_day_gaps", """
SELECT user_id, day, CAST(day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS gap
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)""")
def user_day_gaps(spark, sf_dir):
    days = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    return day_gaps(days, ["user_id"], "day", range_rows=2000)


# Last days of the windows, from before the first to after the last order and event.
_QUARTER_ENDS = [date(y, m, d) for y in range(1992, 2002) for m, d in ((3, 31), (6, 30), (9, 30), (12, 31))]
_WEEK_ENDS = [date(2024, 1, d) for d in (7, 14, 21, 28)]
# Sketches of this size err by less than half of that, at 99 percent.
_SKETCH_SIZE, _RANK_ERROR = 800, 0.01


@query("rolling_price_medians", """
WITH e AS (SELECT CAST(u AS DATE) AS window_end FROM generate_series(DATE '1992-04-01', DATE '2002-01-01', INTERVAL 3 MONTH) g(x), LATERAL (SELECT x - INTERVAL 1 DAY AS u))
SELECT window_end, o_orderpriority, count(*) AS orders, true AS close_to_median
FROM orders JOIN e ON CAST(o_orderdate AS DATE) <= window_end AND CAST(o_orderdate AS DATE) > window_end - 120
WHERE o_totalprice IS NOT NULL GROUP BY 1, 2""")
def rolling_price_medians(spark, sf_dir):
    """Medians over 120 days from stored days, and whether their rank is within one percent.

    Orders meet the window ends a second time to measure the error only.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.to_date("o_orderdate").alias("day"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")
    )
    stored = durable(day_sketches(orders, ["o_orderpriority"], "day", "cents", _SKETCH_SIZE))
    windows = durable(merged_windows(stored, ["o_orderpriority"], "day", _QUARTER_ENDS, 120).select(
        "o_orderpriority", "window_end", "values", sketch_quantile(F.col("sketch"), 0.5).alias("median")
    ))
    near = (F.col("day") <= F.col("window_end")) & (F.col("day") > F.date_sub("window_end", 120))
    ends = windows.withColumnRenamed("o_orderpriority", "p")
    seen = orders.join(ends, (F.col("o_orderpriority") == F.col("p")) & near)
    errors = rank_error(seen, ["o_orderpriority", "window_end"], "cents", "median", 0.5).drop("values")
    return windows.join(errors, ["o_orderpriority", "window_end"]).select(
        "window_end", "o_orderpriority", F.col("values").alias("orders"),
        (F.col("rank_error") <= _RANK_ERROR).alias("close_to_median"),
    )


@query("weekly_cadence", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
g AS (SELECT user_id, day, day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS gap FROM d),
e AS (SELECT DISTINCT CAST(w AS DATE) AS window_end FROM generate_series(DATE '2024-01-07', DATE '2024-01-28', INTERVAL 7 DAY) s(w)),
k AS (SELECT user_id, window_end, gap FROM g JOIN e ON day <= window_end AND day > window_end - 14 WHERE gap > 0)
SELECT user_id, window_end, count(*) AS gaps, CAST(greatest(1, quantile_disc(gap, 0.5)) AS INTEGER) AS cadence FROM k GROUP BY 1, 2""")
def weekly_cadence(spark, sf_dir):
    """Usual days between active days over two weeks; so few gaps that sketches hold them all."""
    days = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    gaps = day_gaps(days, ["user_id"], "day").filter(F.col("gap") > 0)
    stored = durable(day_sketches(gaps, ["user_id"], "day", "gap"))
    windows = merged_windows(stored, ["user_id"], "day", _WEEK_ENDS, 14)
    return windows.select(
        "user_id", "window_end", F.col("values").alias("gaps"), typical_gap_of(F.col("sketch"), 7).alias("cadence")
    )
