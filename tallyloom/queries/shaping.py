"""Unpivots, set operations, calendars, typed projections and function families."""

from pyspark.sql import functions as F

from tallyloom.functions.cleaning import first_number, locale_decimal, multi_format_timestamp, null_sentinels
from tallyloom.operators.reshape import columns_with_suffix, unpivot_columns
from tallyloom.plans.calendar import calendar_dimension
from tallyloom.queries import query, table


@query("unpivot_by_suffix", """
SELECT l_orderkey, l_linenumber, l_partkey, 'QUANTITY_SHARE' AS measure, CAST(l_quantity AS DECIMAL(18,2)) AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'PRICE_SHARE', CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'DISCOUNT_SHARE', CAST(l_discount AS DECIMAL(18,2)) FROM lineitem""")
def unpivot_by_suffix(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").withColumnsRenamed({
        "l_quantity": "quantity_share", "l_extendedprice": "Price_Share",
        "l_discount": "DISCOUNT_SHARE", "l_tax": "TAX_SHARE",
    })
    chosen = columns_with_suffix(line, "_SHARE", excluded=["TAX_SHARE"])
    return unpivot_columns(
        line, ["l_orderkey", "l_linenumber", "l_partkey"], chosen, "measure", "value",
        "decimal(18,2)", upper_names=True,
    )


@query("union_of_nations", """
SELECT 'all' AS kind, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 2
UNION ALL SELECT 'all', s_nationkey, count(*) FROM supplier GROUP BY 2
UNION ALL SELECT 'distinct', nation, 1 FROM (
  SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier)""")
def union_of_nations(spark, sf_dir):
    customer, supplier = (table(spark, sf_dir, n) for n in ("customer", "supplier"))
    keys = [customer.select(F.col("c_nationkey").alias("nation")),
            supplier.select(F.col("s_nationkey").alias("nation"))]
    counted = [k.groupBy("nation").agg(F.count(F.lit(1)).alias("n")) for k in keys]
    every = counted[0].unionByName(counted[1]).select(F.lit("all").alias("kind"), "nation", "n")
    once = keys[0].union(keys[1]).distinct().select(
        F.lit("distinct").alias("kind"), "nation", F.lit(1).cast("long").alias("n")
    )
    return every.unionByName(once)


@query("order_calendar", """
WITH d AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders),
r AS (SELECT d, CASE WHEN year(d) <= 1998 THEN '1998' ELSE '2001' END AS c,
  CASE WHEN year(d) <= 1998 THEN DATE '1998-10-04' ELSE DATE '2001-10-07' END AS r1,
  CASE WHEN year(d) <= 1998 THEN DATE '1998-10-25' ELSE DATE '2001-10-28' END AS r2 FROM d)
SELECT d AS dt_data, CAST(year(d) AS INTEGER) AS nr_ano, CAST(month(d) AS INTEGER) AS nr_mes,
  strftime(d, '%b') AS ds_mes_abrev, strftime(d, '%Y-%m') AS ds_ano_mes, c AS ds_ciclo_eleitoral,
  CAST(r1 - d AS INTEGER) AS nr_dias_ate_1t, CAST(r2 - d AS INTEGER) AS nr_dias_ate_2t FROM r""")
def order_calendar(spark, sf_dir):
    bounds = table(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    cycles = {"1998": ("1998-10-04", "1998-10-25"), "2001": ("2001-10-07", "2001-10-28")}
    return calendar_dimension(bounds, cycles, 1998)


@query("typed_projection", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, upper(o_orderpriority) AS priority
FROM orders""")
def typed_projection(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    raw = orders.select(
        F.col("o_orderkey").cast("string").alias("KEY"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("DAY"),
        F.translate(F.format_number("o_totalprice", 2), ",.", ".,").alias("PRICE"),
        F.when(F.col("o_orderstatus") == "P", "#NE#").otherwise(F.col("o_orderstatus")).alias("STATUS"),
        F.lower("o_orderpriority").alias("PRIORITY"),
    )
    return raw.select(
        null_sentinels(F.col("KEY")).cast("long").alias("o_orderkey"),
        F.to_date(multi_format_timestamp(F.col("DAY"))).alias("day"),
        locale_decimal(F.col("PRICE")).alias("price"),
        null_sentinels(F.col("STATUS")).alias("status"),
        F.upper(null_sentinels(F.col("PRIORITY"))).alias("priority"),
    )


@query("event_rows_dropped", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_discount * 1000 AS DECIMAL(9,2)) AS share
FROM lineitem WHERE l_returnflag <> 'A' AND l_linestatus <> 'F' AND l_discount * 1000 <= 70""")
def event_rows_dropped(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    raw = line.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") == "A", " ").otherwise(F.col("l_returnflag")).alias("name"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit(" "), "l_returnflag")).otherwise(
            F.lit("27 mar")
        ).alias("period"),
        F.concat((F.col("l_discount") * 1000).cast("decimal(9,2)").cast("string"), F.lit("%")).alias("cell"),
    )
    kept = raw.filter(
        (F.trim("name") != "") & (F.trim("period") != "") & (F.trim("name") != F.trim("period"))
    )
    return kept.select(
        "l_orderkey", "l_linenumber", "l_partkey", first_number(F.col("cell")).alias("share")
    ).filter(F.col("share").between(0, 70))


@query("function_families", r"""
SELECT o_orderkey, trim('  ' || o_orderpriority || ' ') AS f_trim, lower(o_orderpriority) AS f_lower,
  substr(o_orderpriority, 1, 3) AS f_substr, replace(o_orderpriority, '-', '_') AS f_replace,
  translate(o_orderpriority, 'EIO', 'eio') AS f_translate,
  regexp_replace(o_orderpriority, '[^A-Z]', '', 'g') AS f_regexp_replace,
  nullif(regexp_extract(o_orderpriority, '([A-Z]+)$', 1), '') AS f_regexp_extract,
  array_to_string(regexp_extract_all(o_orderpriority, '([A-Z])', 1), '.') AS f_extract_all,
  regexp_matches(o_orderpriority, 'IG|OW') AS f_rlike, o_orderpriority LIKE '%M%' AS f_like,
  CAST(length(o_orderpriority) AS INTEGER) AS f_length, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS f_format,
  sha256(o_orderpriority || '|' || o_orderstatus) AS f_sha,
  array_to_string(list_sort(list_transform(string_split(o_orderpriority, '-'), lambda x: lower(x))), '|') AS f_array,
  try_cast(o_orderpriority AS INTEGER) AS f_try_cast, strftime(o_orderdate, '%Y-%m') AS f_month,
  CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INTEGER) AS f_datediff,
  CAST(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH AS DATE) AS f_add_months,
  CAST(CAST(o_orderdate AS DATE) - 120 AS DATE) AS f_date_sub,
  greatest(1, nullif(o_custkey % 7, 3)) AS f_greatest,
  CASE WHEN o_custkey % 3 <> 0 THEN (o_custkey * 10) // (o_custkey % 3) END AS f_try_divide,
  CAST(round(sqrt(o_custkey) * 1000) AS BIGINT) AS f_sqrt, abs(o_custkey - 500) AS f_abs,
  coalesce(nullif(o_orderstatus, 'P'), 'none') AS f_coalesce
FROM orders""")
def function_families(spark, sf_dir):
    p, k = F.col("o_orderpriority"), F.col("o_custkey")
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.trim(F.concat(F.lit("  "), p, F.lit(" "))).alias("f_trim"),
        F.lower(p).alias("f_lower"), F.substring(p, 1, 3).alias("f_substr"),
        F.replace(p, F.lit("-"), F.lit("_")).alias("f_replace"),
        F.translate(p, "EIO", "eio").alias("f_translate"),
        F.regexp_replace(p, "[^A-Z]", "").alias("f_regexp_replace"),
        F.nullif(F.regexp_extract(p, "([A-Z]+)$", 1), F.lit("")).alias("f_regexp_extract"),
        F.array_join(F.regexp_extract_all(p, F.lit("([A-Z])"), F.lit(1)), ".").alias("f_extract_all"),
        p.rlike("IG|OW").alias("f_rlike"), p.like("%M%").alias("f_like"),
        F.length(p).alias("f_length"), F.format_string("%08d", k).alias("f_format"),
        F.sha2(F.concat_ws("|", p, "o_orderstatus"), 256).alias("f_sha"),
        F.array_join(F.array_sort(F.transform(F.split(p, "-"), F.lower)), "|").alias("f_array"),
        p.try_cast("int").alias("f_try_cast"), F.date_format(day, "yyyy-MM").alias("f_month"),
        F.datediff(day, F.to_date(F.lit("1995-01-01"))).alias("f_datediff"),
        F.add_months(day, -12).alias("f_add_months"), F.date_sub(day, 120).alias("f_date_sub"),
        F.greatest(F.lit(1).cast("long"), F.nullif(k % 7, F.lit(3))).alias("f_greatest"),
        F.floor(F.try_divide(k * 10, k % 3)).alias("f_try_divide"),
        F.round(F.sqrt(k) * 1000, 0).cast("long").alias("f_sqrt"), F.abs(k - 500).alias("f_abs"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("none")).alias("f_coalesce"),
    )
