import contextlib
import datetime
import io
import re

from pyspark.sql import functions as F

from tallyloom.plans import registered_polls as P
from tallyloom.queries.sources_of_facts import raw_polls
from tallyloom.session import tune
from tallyloom.sinks.raw_tables import ROW_ID_COLUMN, land_table, read_raw

SMALL = "/root/testdata/sf0.001"
LONG_TEXTS = {"DS_METODOLOGIA_PESQUISA", "DS_PLANO_AMOSTRAL", "DS_SISTEMA_CONTROLE", "DS_DADO_MUNICIPIO"}


def scanned(df):
    """Names of all columns that the scans of a plan read."""
    printed = io.StringIO()
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "1000")
    with contextlib.redirect_stdout(printed):
        df.explain("formatted")
    schemas = re.findall(r"ReadSchema: struct<(.*)>", printed.getvalue())
    assert schemas
    return {name for schema in schemas for name in re.findall(r"(\w+):", schema)}


def landed(spark, root, row_ids):
    rows = raw_polls(tune(spark), SMALL).drop("_ingerido_em", ROW_ID_COLUMN)
    # Each row stands twice, alike up to one of the long texts.
    twice = rows.unionByName(rows.withColumn("DS_PLANO_AMOSTRAL", F.lit("another plan")))
    at = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    land_table(twice, root, "polls", loaded_at=at, row_ids=row_ids)
    return read_raw(spark, root, "polls")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_reader_of_names_reads_no_long_text(spark, tmp_path):
    wide = landed(spark, str(tmp_path / "wide"), False)
    narrow = landed(spark, str(tmp_path / "narrow"), True)
    dimensions = [P.institute_dimension(P.classify_polls(P.stage_polls(raw))) for raw in (wide, narrow)]
    assert LONG_TEXTS <= scanned(dimensions[0])
    assert not LONG_TEXTS & scanned(dimensions[1])
    assert content(dimensions[0]) == content(dimensions[1])


def test_ties_go_to_the_same_row_at_every_load(spark, tmp_path):
    staged = [P.stage_polls(landed(spark, str(tmp_path / name), True)) for name in ("first", "second")]
    assert ROW_ID_COLUMN not in staged[0].columns
    assert content(staged[0]) == content(staged[1])
    assert staged[0].count() == staged[0].select("nr_protocolo_registro").distinct().count()
