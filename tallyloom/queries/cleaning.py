"""Cleaning of text, numbers and dates."""

from pyspark.sql import functions as F

from tallyloom.functions import cleaning as C, periods as P
from tallyloom.queries import query, shared_table, table

_SENTINEL_TEXT = """CASE o_orderkey % 5 WHEN 0 THEN '  ' WHEN 1 THEN ' #NULO# ' WHEN 3 THEN '#NE'
  WHEN 2 THEN '  ' || o_orderpriority || '   x ' ELSE o_orderpriority END"""


@query("null_sentinels", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 2 THEN o_orderpriority || ' x'
  WHEN 4 THEN o_orderpriority END AS cleaned
FROM orders""")
def null_sentinels(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", C.null_sentinels(F.expr(_SENTINEL_TEXT)).alias("cleaned"))


@query("digits_only", "SELECT c_name, CAST(c_custkey AS INTEGER) AS number FROM customer")
def digits_only(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_name", C.digits_only(F.col("c_name"), "int").alias("number"))


@query("locale_decimal", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber <> 7 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS price
FROM lineitem""")
def locale_decimal(spark, sf_dir):
    line = shared_table(spark, sf_dir, "lineitem")
    shown = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    text = F.concat(F.when(F.col("l_linenumber") == 7, " -").otherwise(" "), shown)
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", C.locale_decimal(text).alias("price")
    )


@query("positive_int", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber > 3 THEN CAST(l_quantity AS INTEGER) * 1000 END AS strict,
  CASE WHEN l_linenumber >= 3 THEN CAST(l_quantity AS INTEGER) * 1000 END AS lenient
FROM lineitem""")
def positive_int(spark, sf_dir):
    line = shared_table(spark, sf_dir, "lineitem")
    text = F.expr("""CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN '-1'
      WHEN 3 THEN cast(cast(l_quantity AS int) AS string) || '.000,00'
      ELSE cast(cast(l_quantity AS int) AS string) || '.000' END""")
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        C.positive_int(text).alias("strict"),
        C.positive_int(text, allow_fraction=True).alias("lenient"),
    )


@query("fraction_to_percent", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(CAST(l_discount AS DECIMAL(12,8)) * 100 AS DECIMAL(9,4)) AS percent
FROM lineitem""")
def fraction_to_percent(spark, sf_dir):
    line = shared_table(spark, sf_dir, "lineitem")
    text = F.concat(F.lit("   "), F.translate(F.format_number("l_discount", 6), ".", ","))
    fraction = C.locale_decimal(text, "decimal(12,8)")
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", C.fraction_to_percent(fraction).alias("percent")
    )


@query("multi_format_timestamps", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN CAST(o_orderdate AS DATE) END AS day
FROM orders""")
def multi_format_timestamps(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = F.expr("""CASE o_orderkey % 5
      WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')
      WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd')
      WHEN 2 THEN ' ' || date_format(o_orderdate, 'dd/MM/yyyy HH:mm:ss')
      WHEN 3 THEN date_format(o_orderdate, 'dd/MM/yyyy')
      ELSE date_format(o_orderdate, 'dd.MM.yyyy') END""")
    return orders.select("o_orderkey", F.to_date(C.multi_format_timestamp(text)).alias("day"))


@query("first_number", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber < 7 THEN CAST(l_extendedprice AS DECIMAL(9,2)) END AS number
FROM lineitem""")
def first_number(spark, sf_dir):
    line = shared_table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    text = F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(
        F.concat(F.lit("± "), F.translate(price, ".", ","), F.lit(" p.p. (3)"))
    )
    return line.select("l_orderkey", "l_linenumber", "l_partkey", C.first_number(text).alias("number"))


_PLAN_TEXT = """concat(text, CASE doc_id % 3
  WHEN 0 THEN concat(' Nível de confiança de ', cast(90 + doc_id % 10 AS varchar(9)), '%.')
  WHEN 1 THEN concat(' ', cast(80 + doc_id % 20 AS varchar(9)), ',0% de confiança')
  ELSE ' sem nível' END)"""


@query("confidence_levels", f"""
WITH plans AS (SELECT doc_id, lower({_PLAN_TEXT} || ' ' || lang) AS plan FROM documents)
SELECT doc_id, CAST(coalesce(
  nullif(regexp_extract(plan, 'confian[cç]a[^0-9]{{0,40}}([0-9]{{2}})([,.][0-9]+)? ?%', 1), ''),
  nullif(regexp_extract(plan, '([0-9]{{2}})([,.][0-9]+)? ?%[^.]{{0,40}}confian', 1), ''))
  AS INTEGER) AS level
FROM plans""")
def confidence_levels(spark, sf_dir):
    documents = shared_table(spark, sf_dir, "documents")
    plan = C.search_text(F.expr(_PLAN_TEXT), F.col("lang"))
    return documents.select("doc_id", C.confidence_level(plan).alias("level"))


_MONTHS = {
    1: "Jan", 2: "fev", 3: "Mar", 4: "abril", 5: "mai", 6: "jun", 7: "jul", 8: "ago", 9: "set",
    10: "Out", 11: "nov", 12: "dezembro",
}


@query("period_dates", """
WITH p AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 AS INTEGER) AS e,
    CASE WHEN o_orderkey % 2 = 0 THEN DATE '2000-02-15' ELSE DATE '2001-08-10' END AS ref
  FROM orders),
b AS (
  SELECT o_orderkey, ref,
    try_cast(strftime(ref, '%Y') || strftime(s, '-%m-%d') AS DATE) AS s,
    try_cast(strftime(ref, '%Y') || strftime(e, '-%m-%d') AS DATE) AS e FROM p)
SELECT o_orderkey,
  CAST(CASE WHEN s > ref THEN s - INTERVAL 12 MONTH ELSE s END AS DATE) AS start_day,
  CAST(CASE WHEN e > ref THEN e - INTERVAL 12 MONTH ELSE e END AS DATE) AS end_day
FROM b""")
def period_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    first = F.to_date("o_orderdate")
    last = F.date_add(first, (F.col("o_orderkey") % 6).cast("int"))
    names = F.array(*[F.lit(_MONTHS[m]) for m in range(1, 13)])

    def shown(day):
        return F.concat(F.day(day).cast("string"), F.lit(" "), F.element_at(names, F.month(day)))

    reference = F.when(F.col("o_orderkey") % 2 == 0, F.to_date(F.lit("2000-02-15"))).otherwise(
        F.to_date(F.lit("2001-08-10"))
    )
    text = F.concat(shown(first), F.lit(" - "), shown(last))
    periods = orders.select(
        "o_orderkey", reference.alias("ref"),
        P.period_days(text).alias("days"), P.period_months(text).alias("months"),
    )

    def boundary(position):
        plain = P.period_boundary(F.col("days"), F.col("months"), position, F.col("ref"))
        return P.roll_back_future(plain, F.col("ref"))

    return periods.select(
        "o_orderkey", boundary(1).alias("start_day"), boundary(-1).alias("end_day")
    )


@query("strip_markup", "SELECT p_partkey, p_name AS name FROM part")
def strip_markup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    noisy = F.expr("""CASE p_partkey % 5
      WHEN 0 THEN p_name || '[12][nota 3]'
      WHEN 1 THEN '<b>' || replace(p_name, ' ', '   ') || '</b>'
      WHEN 2 THEN p_name || '<REF group="a">quoted [x] text'
      WHEN 3 THEN p_name || 'ref name="' || p_brand || '">«long»</ref>'
      ELSE '  ' || p_name || ' ' END""")
    return part.select("p_partkey", C.strip_markup(noisy).alias("name"))


@query("strip_markup_pages", r"""
SELECT page_id, sha256(clean) AS digest, length(clean) AS size FROM (
  SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html,
    '<[^>]*>', '', 'g'), '\[[^\]]*\]', '', 'g'), ' +', ' ', 'g'), ' ') AS clean FROM pages)""")
def strip_markup_pages(spark, sf_dir):
    clean = shared_table(spark, sf_dir, "pages").select(
        "page_id", C.strip_markup(F.col("html")).alias("clean")
    )
    return clean.select(
        "page_id", F.sha2("clean", 256).alias("digest"), F.length("clean").cast("long").alias("size")
    )


@query("name_keys", r"""
SELECT doc_id, sha256(array_to_string(list_sort(list_filter(string_split(
  lower(regexp_replace(text, '[^A-Za-z0-9À-ÿ]', ' ', 'g')), ' '), lambda w: w <> '')), '|')) AS digest
FROM documents""")
def name_keys(spark, sf_dir):
    documents = shared_table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.sha2(C.name_key(F.col("text")), 256).alias("digest"))


@query("fold_keys", f"""
SELECT doc_id, sha256(folded) AS digest, length(folded) AS size FROM (
  SELECT doc_id, regexp_replace(lower(translate(text, '{C.ACCENTED}', '{C.UNACCENTED}')),
    '[^a-z0-9]', '', 'g') AS folded FROM documents)""")
def fold_keys(spark, sf_dir):
    folded = shared_table(spark, sf_dir, "documents").select(
        "doc_id", C.fold_key(F.col("text")).alias("folded")
    )
    return folded.select(
        "doc_id", F.sha2("folded", 256).alias("digest"), F.length("folded").cast("long").alias("size")
    )


@query("search_text", """
SELECT c_custkey, lower(concat_ws(' ', c_name, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END,
  n_name)) AS searched
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def search_text(spark, sf_dir):
    customer, nation = (table(spark, sf_dir, n) for n in ("customer", "nation"))
    segment = F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment"))
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", C.search_text(F.col("c_name"), segment, F.col("n_name")).alias("searched")
    )


_TITLE = """array_to_string(list_transform(string_split(lower({0}), ' '),
  lambda w: upper(w[1]) || w[2:]), ' ')"""


@query("column_titles", f"""
SELECT p_partkey, {_TITLE.format("p_name || ' ' || p_type")} AS title FROM part""")
def column_titles(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    column = F.concat(
        F.upper(F.replace(F.concat_ws(" ", "p_name", "p_type"), F.lit(" "), F.lit("_"))),
        F.lit("_PE_SHARE"),
    )
    return part.select("p_partkey", C.title_from_column_name(column, "_PE_SHARE").alias("title"))


@query("display_names", f"""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand
  ELSE {_TITLE.format("p_name || ' d''x'")} END AS name
FROM part""")
def display_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    trade = C.null_sentinels(F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).otherwise("#NULO#"))
    legal = F.upper(F.concat("p_name", F.lit(" d'x")))
    return part.select("p_partkey", C.display_name(trade, legal).alias("name"))
