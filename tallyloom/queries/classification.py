"""Ordered rules, label splits, measures and flags."""

from pyspark.sql import functions as F

from tallyloom.functions import classify as K, measures as M
from tallyloom.queries import query, shared_table, table


def _whole_word(*words: str) -> str:
    return "|".join(rf"(^|[^\p{{L}}\p{{N}}_]){w}([^\p{{L}}\p{{N}}_]|$)" for w in words)


@query("answer_classes", r"""
SELECT doc_id, CASE
  WHEN regexp_matches(t, '^(header|column)[ 0-9]*$') THEN 'Artefato'
  WHEN regexp_matches(t, 'vantagem|diferen|lead|margem|amostra') THEN 'Artefato'
  WHEN regexp_matches(t, 'indecis|absten|absent|outros|branco|nulo|nenhum|nao sabe|não sabe')
    THEN 'Não-resposta' ELSE 'Candidato' END AS class
FROM (SELECT doc_id, lower(text || CASE doc_id % 4 WHEN 0 THEN ' Indecisos' WHEN 1 THEN ' Não sabe'
  WHEN 2 THEN ' Vantagem' ELSE '' END) AS t FROM documents)""")
def answer_classes(spark, sf_dir):
    text = F.expr("""text || CASE doc_id % 4 WHEN 0 THEN ' Indecisos' WHEN 1 THEN ' Não sabe'
      WHEN 2 THEN ' Vantagem' ELSE '' END""")
    documents = shared_table(spark, sf_dir, "documents")
    return documents.select("doc_id", K.classify_answer(text).alias("class"))


@query("method_classes", rf"""
SELECT doc_id, CASE
  WHEN regexp_matches(t, '{_whole_word("ura", "ivr")}|automatizad|resposta aud')
    THEN 'Telefônica automatizada (URA)'
  WHEN regexp_matches(t, '{_whole_word("cati")}|telef') THEN 'Telefônica com entrevistador'
  WHEN regexp_matches(t, '{_whole_word("web", "sms")}|online|on-line|internet|whatsapp|link')
    THEN 'Web / painel online'
  WHEN regexp_matches(t, 'pessoa|domicil|residenc|residência|face a face|face-a-face|presencia'
    || '|pontos? de fluxo|porta a porta|in loco') THEN 'Presencial'
  ELSE 'Não classificada' END AS class
FROM (SELECT doc_id, lower(text || CASE doc_id % 6 WHEN 0 THEN ' questionário estruturado'
  WHEN 1 THEN ' URA' WHEN 2 THEN ' (CATI)' WHEN 3 THEN ' web.' WHEN 4 THEN ' ponto de fluxo'
  ELSE '' END) AS t FROM documents)""")
def method_classes(spark, sf_dir):
    text = F.expr("""text || CASE doc_id % 6 WHEN 0 THEN ' questionário estruturado'
      WHEN 1 THEN ' URA' WHEN 2 THEN ' (CATI)' WHEN 3 THEN ' web.' WHEN 4 THEN ' ponto de fluxo'
      ELSE '' END""")
    documents = shared_table(spark, sf_dir, "documents")
    return documents.select("doc_id", K.classify_method(text).alias("class"))


@query("code_labels", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Final' END AS status
FROM orders""")
def code_labels(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    labels = (("O", "Open"), ("F", "Final"))
    return orders.select("o_orderkey", K.code_label(F.col("o_orderstatus"), labels).alias("status"))


@query("split_labels", """
SELECT p_partkey,
  CASE p_partkey % 3 WHEN 2 THEN p_type ELSE p_name END AS name,
  CASE p_partkey % 3 WHEN 0 THEN 'Sem partido' WHEN 1 THEN p_brand END AS token
FROM part""")
def split_labels(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    label = F.expr("""CASE p_partkey % 3 WHEN 0 THEN p_name || ' SEM partido'
      WHEN 1 THEN p_name || ' ' || p_brand ELSE p_type END""")
    name, token = K.split_trailing_token(label)
    return part.select("p_partkey", name.alias("name"), token.alias("token"))


@query("measures_and_flags", """
WITH j AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_tax,
    CASE WHEN l_linenumber <> 2 THEN CAST(l_quantity AS INTEGER) - 1 END AS n,
    CASE WHEN l_linenumber <> 3 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
    CAST(o_orderdate AS DATE) AS registered, CAST(l_shipdate AS DATE) AS published,
    CAST(o_orderdate AS DATE) + CAST(l_linenumber AS INTEGER) AS s,
    CASE WHEN l_linenumber <> 4 THEN CAST(o_orderdate AS DATE) + CAST(l_partkey % 9 AS INTEGER) END AS e,
    CASE WHEN l_returnflag = 'A' THEN 'trade' END AS trade
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
f AS (
  SELECT *, n IS NULL AS bad_sample, amount IS NULL OR amount = 0 AS no_amount, s > e AS inverted,
    published < e AS early, published - registered < 5 AS short_notice, trade IS NULL AS no_trade
  FROM j)
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(CASE WHEN n <> 0 THEN (2 * CAST(amount * 100 AS HUGEINT) + n) // (2 * n) END AS BIGINT) AS cost_cents,
  CASE WHEN n > 0 THEN CAST(CAST(round(0.98 / sqrt(n) * 1000000) AS BIGINT) AS BIGINT) END AS margin_ppm,
  CAST(published - e AS INTEGER) AS wait_days, CAST(e - s + 1 AS INTEGER) AS field_days,
  bad_sample, no_amount, inverted, early, short_notice, no_trade,
  bad_sample OR no_amount OR inverted OR early OR short_notice AS any_alert
FROM f""")
def measures_and_flags(spark, sf_dir):
    line, orders = (table(spark, sf_dir, n) for n in ("lineitem", "orders"))
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey)
    number, ordered = F.col("l_linenumber"), F.to_date("o_orderdate")
    facts = joined.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(number != 2, F.col("l_quantity").cast("int") - 1).alias("n"),
        F.when(number != 3, F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"),
        ordered.alias("registered"), F.to_date("l_shipdate").alias("published"),
        F.date_add(ordered, number.cast("int")).alias("s"),
        F.when(number != 4, F.date_add(ordered, (F.col("l_partkey") % 9).cast("int"))).alias("e"),
        F.when(F.col("l_returnflag") == "A", F.lit("trade")).alias("trade"),
    )
    flags = K.quality_flags(
        F.col("n"), F.col("amount"), F.col("s"), F.col("e"), F.col("published"),
        F.col("registered"), F.col("trade"), 5,
    )
    short = ("bad_sample", "no_amount", "inverted", "early", "short_notice", "no_trade")
    cost = F.round(M.cost_per_unit(F.col("amount") * 100, F.col("n")), 0).cast("long")
    margin = F.round(M.theoretical_margin(F.col("n")) * 1_000_000, 0).cast("long")
    return facts.select(
        "l_orderkey", "l_linenumber", "l_partkey", cost.alias("cost_cents"),
        margin.alias("margin_ppm"),
        M.day_gap(F.col("published"), F.col("e")).alias("wait_days"),
        M.field_length(F.col("s"), F.col("e")).alias("field_days"),
        *[flag.alias(name) for name, flag in zip(short, flags.values())],
        K.any_alert(*list(flags.values())[:5]).alias("any_alert"),
    )


@query("scope_filters", """
SELECT c_custkey, n_name = 'NATION_3' AS national
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 0
WHERE n_nationkey IS NOT NULL AND (n_regionkey = 3 OR c_mktsegment LIKE '%BUILD%')""")
def scope_filters(spark, sf_dir):
    customer, nation = (table(spark, sf_dir, n) for n in ("customer", "nation"))
    listed = nation.filter(F.col("n_regionkey") != 0)
    joined = customer.join(listed, customer.c_nationkey == listed.n_nationkey, "left")
    in_scope = (F.col("n_regionkey") == 3) | F.col("c_mktsegment").contains("BUILD")
    return joined.filter(F.col("n_nationkey").isNotNull() & in_scope).select(
        "c_custkey", (F.col("n_name") == "NATION_3").alias("national")
    )


@query("names_to_review", """
SELECT p_partkey, trim(coalesce(n, '')) = '' OR regexp_matches(n, '<|\\[|ref name=') AS bad
FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN ' ' WHEN 1 THEN p_name || '[1]'
  WHEN 2 THEN p_name END AS n FROM part)""".replace("\\\\", "\\"))
def names_to_review(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = F.expr("""CASE p_size % 4 WHEN 0 THEN ' ' WHEN 1 THEN p_name || '[1]'
      WHEN 2 THEN p_name END""")
    return part.select("p_partkey", K.blank_or_marked_up(name).alias("bad"))
