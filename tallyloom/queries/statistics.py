"""Poll statistics, with events as poll answers: user group = institute, type = candidate."""

from pyspark.sql import functions as F

from tallyloom.functions.classify import CANDIDATE, NON_RESPONSE
from tallyloom.operators import stats as S
from tallyloom.queries import query, table

_POLLS = """
e AS (SELECT CAST(ts AS DATE) AS day, CAST(user_id % 20 AS INTEGER) AS inst, event_type AS label,
    event_type = 'error' AS nr, CAST(value AS DECIMAL(18,2)) AS v FROM events),
m AS (SELECT day, inst, label, nr, CAST((2 * CAST(sum(v) * 1000000 AS HUGEINT) + count(*)) // (2 * count(*)) AS HUGEINT) AS micro
  FROM e GROUP BY ALL),
s AS (SELECT day, inst, CASE WHEN nr THEN 'NR' ELSE label END AS label, sum(micro) AS micro FROM m GROUP BY ALL),
t AS (SELECT *, sum(micro) OVER (PARTITION BY day, inst) AS total FROM s),
p AS (SELECT day, inst, label, (2 * micro * 100000000 + total) // (2 * total) AS share FROM t)"""


def _scaled(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(38,6)) / 1000000 AS DECIMAL(18,6))"


def _polls(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    answers = events.select(
        F.to_date("ts").alias("day"), (F.col("user_id") % 20).cast("int").alias("inst"),
        F.col("event_type").alias("label"),
        F.when(F.col("event_type") == "error", NON_RESPONSE).otherwise(CANDIDATE).alias("kind"),
        F.col("value").cast("decimal(18,2)").alias("share"),
    )
    means = S.poll_means(answers, ["day", "inst"], "label", "kind", "share")
    return S.rescale_polls(means, ["day", "inst"], "label", "kind", "share")


@query("rescaled_polls", f"WITH {_POLLS} SELECT day, inst, label, {_scaled('share')} AS share FROM p")
def rescaled_polls(spark, sf_dir):
    return _polls(spark, sf_dir)


@query("day_mean_shares", f"""
WITH {_POLLS},
n AS (SELECT day, count(DISTINCT inst) AS polls FROM p GROUP BY day)
SELECT day, label, polls, {_scaled('(2 * total + polls) // (2 * polls)')} AS share
FROM (SELECT day, label, sum(share) AS total FROM p GROUP BY 1, 2) JOIN n USING (day)""")
def day_mean_shares(spark, sf_dir):
    return S.day_means(_polls(spark, sf_dir), ["inst"], "day", "label", "share")


@query("period_bars", f"""
WITH {_POLLS}
SELECT label, count(*) AS polls, {_scaled('(2 * sum(share) + count(*)) // (2 * count(*))')} AS mean,
  {_scaled('min(share)')} AS low, {_scaled('max(share)')} AS high
FROM p WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY label""")
def period_bars(spark, sf_dir):
    first, last = (F.to_date(F.lit(d)) for d in ("2024-01-10", "2024-01-20"))
    return S.period_bars(_polls(spark, sf_dir), "day", "label", "share", first, last)


@query("duel_shares", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(greatest(l_quantity, 25) AS DECIMAL(9,2)) AS hi,
    CAST(least(l_quantity, 25) AS DECIMAL(9,2)) AS lo,
    CASE WHEN l_returnflag <> 'A' THEN CAST(l_discount * 100 AS DECIMAL(9,2)) END AS u FROM lineitem),
g AS (SELECT *, CAST(hi * 100 AS HUGEINT) AS h, CAST(lo * 100 AS HUGEINT) AS l,
    CAST(coalesce(u, 100 - hi - lo) * 100 AS HUGEINT) AS n FROM d)
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(CAST((2 * h * 100000000 + h + l + n) // (2 * (h + l + n)) AS DECIMAL(38,6)) / 1000000 AS DECIMAL(18,6)) AS ahead,
  CAST(CAST((2 * l * 100000000 + h + l + n) // (2 * (h + l + n)) AS DECIMAL(38,6)) / 1000000 AS DECIMAL(18,6)) AS behind,
  CAST(CAST((2 * n * 100000000 + h + l + n) // (2 * (h + l + n)) AS DECIMAL(38,6)) / 1000000 AS DECIMAL(18,6)) AS undecided
FROM g""")
def duel_shares(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    high = F.greatest("l_quantity", F.lit(25.0)).cast("decimal(9,2)")
    low = F.least("l_quantity", F.lit(25.0)).cast("decimal(9,2)")
    undecided = F.when(
        F.col("l_returnflag") != "A", (F.col("l_discount") * 100).cast("decimal(9,2)")
    )
    parts = S.rescale_duel(high, low, undecided)
    names = ("ahead", "behind", "undecided")
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[p.alias(n) for p, n in zip(parts, names)]
    )


@query("largest_remainders", f"""
WITH {_POLLS},
f AS (SELECT *, share // 100000 AS fl, share % 100000 AS rest FROM p),
k AS (SELECT *, 1000 - sum(fl) OVER (PARTITION BY day, inst) AS missing,
  row_number() OVER (PARTITION BY day, inst ORDER BY rest DESC, label) AS place FROM f)
SELECT day, inst, label, CAST(CAST(fl + CASE WHEN place <= missing THEN 1 ELSE 0 END AS DECIMAL(18,1)) / 10 AS DECIMAL(9,1)) AS shown
FROM k""")
def largest_remainders(spark, sf_dir):
    rounded = S.largest_remainder(_polls(spark, sf_dir), ["day", "inst"], "label", "share", "shown")
    return rounded.select("day", "inst", "label", "shown")
