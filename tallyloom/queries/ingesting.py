"""Reading and landing: delimited text, archives, HTML tables, raw tables, text blocks."""

import io
import os
import uuid
import zipfile
from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from tallyloom.config import is_production, materialise
from tallyloom.functions.lines import render_line
from tallyloom.operators.numbering import number_rows
from tallyloom.queries import query, shared_table, table
from tallyloom.session import durable, scratch_path
from tallyloom.sinks.blocks import write_block
from tallyloom.sinks.marts import replace_days
from tallyloom.sinks.raw_tables import land_table, read_raw
from tallyloom.sources.blocks import BLOCK_FIELDS, parse_lines, read_block, wrong_lines
from tallyloom.sources.delimited import (
    ORIGIN_COLUMN, read_delimited_text, read_zipped_csv, rows_of_archives, tagged, union_parts,
)
from tallyloom.sources.html_tables import extract_html_tables
from tallyloom.sources.registry import land_sources
from tallyloom.sources.seeds import REGISTERED_CANDIDATES_SCHEMA, read_seed


@query("delimited_text", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'Região; ' || o_orderpriority || '  ' END AS label,
  CASE WHEN o_orderstatus = 'O' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS customer,
  CASE WHEN o_orderstatus = 'O' THEN '1T' ELSE '2T' END AS turno, true AS from_csv FROM orders""")
def delimited_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    label = F.when(F.col("o_orderstatus") == "P", "").otherwise(
        F.concat(F.lit("Região; "), "o_orderpriority", F.lit("  "))
    )
    shown = [F.col("o_orderkey").cast("string").alias(" key "), label.alias("label")]
    parts = {
        "1T": orders.filter("o_orderstatus = 'O'").select(*shown),
        "2T": orders.filter("o_orderstatus <> 'O'").select(
            *shown, F.col("o_custkey").cast("string").alias("customer")
        ),
    }
    read = []
    for round_name, part in parts.items():
        path = scratch_path(spark, "delimited")
        part.write.csv(
            path, sep=";", header=True, encoding="ISO-8859-1", escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        read.append(tagged(read_delimited_text(spark, path), "turno", round_name))
    return union_parts(read).select(
        "key", "label", "customer", "turno", F.col(ORIGIN_COLUMN).endswith(".csv").alias("from_csv")
    )


@query("quoted_ranges", """
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name || chr(10) || '"' || c_mktsegment || '";' || repeat(chr(10) || c_name, CAST(c_custkey % 5 AS INTEGER)) AS note,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation FROM customer""")
def quoted_ranges(spark, sf_dir):
    """One file with line breaks, quotes and separators in quotes, read in ranges of 32 KB."""
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('";'), F.expr("repeat('\n' || c_name, cast(c_custkey % 5 AS int))"))
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), note.alias("note"),
        F.when(F.pmod("c_custkey", F.lit(3)) == 0, "").otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
    )
    path = scratch_path(spark, "quoted")
    rows.coalesce(1).write.csv(path, sep=";", header=True, encoding="ISO-8859-1", escape='"')
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    try:
        for name, value in zip(names, ("32k", "1k")):
            spark.conf.set(name, value)
        return durable(read_delimited_text(spark, path, origin=False), "quoted-rows")
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def _archives(rows):
    """Zip archives, one per incoming batch: two members with different columns and a text file."""

    def pack(batches):
        for batch in batches:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("leia-me.txt", "not a table")
                for member, part in (("PART.CSV", batch[batch["odd"] == 0]), ("more.csv", batch[batch["odd"] == 1])):
                    part = part.drop(columns=["odd"] if member == "PART.CSV" else ["odd", "label"])
                    archive.writestr(member, part.to_csv(index=False, sep=";").encode("latin-1"))
            yield pd.DataFrame({"path": [f"{batch['key'].iloc[0]}.zip"], "content": [buffer.getvalue()]})

    return rows.mapInPandas(pack, "path string, content binary")


@query("zipped_csv", """
SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 2 = 0 THEN 'Seção "' || c_mktsegment || '"' || chr(10) || 'b;' ELSE '' END AS label,
  CASE WHEN c_custkey % 2 = 0 THEN 'PART.CSV' ELSE 'more.csv' END AS member FROM customer""")
def zipped_csv(spark, sf_dir):
    """Stored archives, columns found in the members, with line breaks and separators in quotes."""
    rows = shared_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias(" name"), F.col("c_custkey").cast("string").alias("key"),
        F.concat(F.lit('Seção "'), "c_mktsegment", F.lit('"\nb;')).alias("label"),
        F.pmod("c_custkey", F.lit(2)).alias("odd"),
    )
    read = rows_of_archives(durable(_archives(rows), "archives"))
    return read.withColumnRenamed(ORIGIN_COLUMN, "member")


@query("zipped_files", """
SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 2 = 0 THEN 'Seção "' || c_mktsegment || '"' || chr(10) || 'b;' ELSE '' END AS label,
  CASE WHEN c_custkey % 2 = 0 THEN 'PART.CSV' ELSE 'more.csv' END AS member FROM customer""")
def zipped_files(spark, sf_dir):
    """The archives as files in the shared folder, read by the data source, one task per member."""
    rows = shared_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias(" name"), F.col("c_custkey").cast("string").alias("key"),
        F.concat(F.lit('Seção "'), "c_mktsegment", F.lit('"\nb;')).alias("label"),
        F.pmod("c_custkey", F.lit(2)).alias("odd"),
    )
    folder = scratch_path(spark, "zips").removeprefix("file://").removeprefix("file:")

    def save(batches):
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                with open(f"{folder}/{uuid.uuid4().hex}.tmp", "wb") as file:
                    file.write(content)
                os.replace(file.name, f"{folder}/{name}")  # a task that runs again replaces its archive
            yield pd.DataFrame({"saved": [len(batch)]})

    _archives(rows).mapInPandas(save, "saved int").agg(F.sum("saved")).first()
    if not os.path.isdir(folder):  # no rows, no archives
        return rows_of_archives(_archives(rows), ["key", "label", "name"]).withColumnRenamed(ORIGIN_COLUMN, "member")
    return read_zipped_csv(spark, folder).withColumnRenamed(ORIGIN_COLUMN, "member")


_PAGE_TABLES = """html || '<table class="wikitable sortable"><tr><th rowspan="2">Instituto</th>'
 || '<th rowspan="2">Data</th><th colspan="2">Nomes</th><th rowspan="2">Amostra</th></tr>'
 || '<tr><th>Um<br>PA</th><th>Dois PB</th></tr><tr><td rowspan="2">Inst ' || page_id || '<sup>[1]</sup></td>'
 || '<td>27 mar</td><td>' || length(html) || ',5%</td><td>' || replace(url, '&', '&amp;') || '</td><td>2.000</td></tr>'
 || '<tr><td>28 mar</td><td colspan="2"> ' || page_id || ' </td></tr></table>'
 || '<table class="plain"><tr><th>Instituto</th><th>Data</th><th>A</th></tr><tr><td>x</td><td>y</td><td>z</td></tr></table>'
 || '<table class="wikitable"><tr><th>Outra</th><th>Data</th></tr><tr><td>x</td><td>y</td></tr></table>'"""


@query("html_tables", """
SELECT page_id, '0' AS tabela_idx, r.row_idx, 'Inst ' || page_id || '[1]' AS instituto_texto,
  CASE r.row_idx WHEN 0 THEN '27 mar' ELSE '28 mar' END AS periodo_texto,
  CASE r.row_idx WHEN 0 THEN '2.000' ELSE '' END AS amostra_texto, '' AS margem_texto,
  'Nomes ' || c.name AS coluna_candidato,
  CASE WHEN r.row_idx = 1 THEN CAST(page_id AS VARCHAR) WHEN c.name = 'UmPA' THEN length(html) || ',5%' ELSE url END AS valor_texto
FROM pages, (VALUES (0), (1)) r(row_idx), (VALUES ('UmPA'), ('Dois PB')) c(name)""")
def html_tables(spark, sf_dir):
    pages = shared_table(spark, sf_dir, "pages").select("page_id", F.expr(_PAGE_TABLES).alias("html"))
    return extract_html_tables(pages)


@query("raw_landing", """
SELECT CAST(o_orderkey AS VARCHAR) AS KEY, CAST(o_custkey AS VARCHAR) AS key_2, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS ST_A,
  strftime(o_orderdate, '%Y-%m-%d') AS coluna, TIMESTAMP '2024-01-02 03:04:05' AS _ingerido_em, (SELECT count(*) FROM orders) AS landed FROM orders""")
def raw_landing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("KEY"), F.col("o_custkey").alias("key "),
        F.nullif("o_orderstatus", F.lit("P")).alias("ST (A)"), F.to_date("o_orderdate").alias(" ="),
    )
    root = scratch_path(spark, "raw")
    land_table(orders.limit(1), root, "orders", loaded_at=datetime(2024, 1, 1))
    rows = land_table(orders, root, "orders", loaded_at=datetime(2024, 1, 2, 3, 4, 5))
    land_table(orders.limit(2), root, "orders", publish=False, loaded_at=datetime(2024, 1, 3))
    return read_raw(spark, root, "orders").withColumn("landed", F.lit(rows).cast("long"))


@query("landing_outcomes", """
SELECT 'customer' AS source, 'ok' AS status, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM customer
UNION ALL SELECT 'nothing', 'failed', NULL, NULL FROM (SELECT 1)
UNION ALL SELECT 'broken', 'failed', NULL, repeat('source is not available ', 200) FROM (SELECT 1)
UNION ALL SELECT 'supplier', 'ok', count(*), NULL FROM supplier""")
def landing_outcomes(spark, sf_dir):
    def broken():
        raise OSError("source is not available " * 200)

    customer, supplier = (table(spark, sf_dir, n) for n in ("customer", "supplier"))
    registry = {
        "customer": lambda: customer, "nothing": lambda: customer.filter("c_custkey < 0"),
        "broken": broken, "supplier": lambda: supplier, "unused": broken,
    }
    outcome = land_sources(
        spark, registry, scratch_path(spark, "landing"), "customer, nothing,broken,supplier"
    )
    # The text of a refused empty extract is not part of the comparison.
    shown = F.when(F.col("source") != "nothing", F.col("error"))
    return outcome.select("source", "status", "rows", shown.alias("error"))


@query("stored_block", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status,
  CAST(o_orderkey AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS beyond FROM orders""")
def stored_block(spark, sf_dir):
    line = render_line(
        F.to_date("o_orderdate"), F.nullif("o_orderstatus", F.lit("P")), F.col("o_orderkey")
    )
    lines = number_rows(table(spark, sf_dir, "orders").select(line.alias("linha")), [F.asc("linha")])
    path = scratch_path(spark, "block")
    write_block(lines, path)
    return parse_lines(read_block(spark, path), ["day", "status", "key", "beyond"])


@query("block_lines_rejected", """
SELECT c_custkey || ';' || c_name || CASE WHEN c_custkey % 3 = 0 THEN ';' ELSE '' END || CASE WHEN c_custkey % 7 = 0 THEN ';' || c_mktsegment || ';x' ELSE '' END AS linha,
  CAST(2 + CAST(c_custkey % 3 = 0 AS INTEGER) + 2 * CAST(c_custkey % 7 = 0 AS INTEGER) AS INTEGER) AS fields, 4 AS expected
FROM customer WHERE 2 + CAST(c_custkey % 3 = 0 AS INTEGER) + 2 * CAST(c_custkey % 7 = 0 AS INTEGER) <> 4""")
def block_lines_rejected(spark, sf_dir):
    """Lines with too few and too many fields, next to right ones, in a stored block."""
    line = F.expr("""concat(c_custkey, ';', c_name, CASE WHEN c_custkey % 3 = 0 THEN ';' ELSE '' END,
      CASE WHEN c_custkey % 7 = 0 THEN concat(';', c_mktsegment, ';x') ELSE '' END)""")
    path = scratch_path(spark, "rejected-block")
    write_block(number_rows(table(spark, sf_dir, "customer").select(line.alias("linha")), [F.asc("linha")]), path)
    return wrong_lines(read_block(spark, path), BLOCK_FIELDS["painel_institutos_mes"])


@query("seed_scan", """
SELECT c_name AS nm_candidato, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment || ', "' || c_nationkey || '"' END AS ds_observacao FROM customer""")
def seed_scan(spark, sf_dir):
    """A lookup file with quotes, separators and empty fields."""
    note = F.concat("c_mktsegment", F.lit(', "'), F.col("c_nationkey").cast("string"), F.lit('"'))
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("nm_candidato"), F.when(F.col("c_acctbal") >= 0, note).alias("ds_observacao")
    )
    path = scratch_path(spark, "seed")
    rows.write.csv(path, header=True, escape='"')
    return read_seed(spark, path, REGISTERED_CANDIDATES_SCHEMA)


@query("layer_views", """
SELECT 'dev_staging__nation' AS dev, 'intermediate__region' AS prod, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey""")
def layer_views(spark, sf_dir):
    """Views of two layers, under a user's own schema and in production."""
    dev = materialise(table(spark, sf_dir, "nation"), "staging", "nation", "dev", is_production("dev"))
    prod = materialise(table(spark, sf_dir, "region"), "intermediate", "region", "dev", is_production("prod"))
    joined = spark.table(dev).join(spark.table(prod), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.lit(dev).alias("dev"), F.lit(prod).alias("prod"), "n_name", "r_name")


_REPRICED = 1995


@query("stored_marts", f"""
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS o_year,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN year(o_orderdate) = {_REPRICED} THEN 2 ELSE 1 END AS DECIMAL(18,2)) AS price,
  count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")
def stored_marts(spark, sf_dir):
    """Two marts bucketed by the order; one year of the first is replaced; joined without a shuffle."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", price.alias("price"), F.year("o_orderdate").alias("o_year")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("extended")
    )
    wide = materialise(orders, "marts", "orders", "queries", False, keys=["o_orderkey"], buckets=8, day="o_year")
    long = materialise(lines, "marts", "order_lines", "queries", False, keys=["l_orderkey"], buckets=8)
    repriced = orders.filter(F.col("o_year") == _REPRICED).withColumn("price", (F.col("price") * 2).cast("decimal(18,2)"))
    replace_days(spark, repriced, *wide.split("."))
    per_order = spark.table(long).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("extended").alias("total")
    )
    joined = spark.table(wide).join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select("o_orderkey", "o_custkey", "o_year", "price", "lines", "total")
