import datetime
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyloom.config import LAYERS, database_name, is_production, materialise
from tallyloom.plans.calendar import calendar_bounds, calendar_dimension
from tallyloom.plans.registered_polls import NOTICE_DAYS
from tallyloom.session import scratch_path, spread
from tallyloom.sinks.blocks import block_text
from tallyloom.sinks.raw_tables import clean_column_names, land_table
from tallyloom.operators.history import read_history
from tallyloom.sources.blocks import parse_block, wrong_lines
from tallyloom.sources.delimited import ORIGIN_COLUMN, read_delimited_text, read_zipped_csv
from tallyloom.sources.html_tables import extract_html_tables, flat_headers, read_table_rows
from tallyloom.sources.registry import select_sources
from tallyloom.sources.seeds import REGISTERED_CANDIDATES_SCHEMA, read_seed
from tallyloom.streaming.visits import count_devices_batch, valid_visits


def pages(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page_id long, html string")


def test_headers_and_spans(spark):
    html = """<table class='x wikitable'><thead><tr><th>Instituto</th><th>Data</th><th colspan=3>Nomes</th><th></th></tr>
      <tr><th>Instituto</th><th>Data</th><th>A</th><th>A</th><th>B</th><th></th></tr></thead>
      <tr><td>I</td><td rowspan=2>27 mar</td><td>1</td><td>2</td><td>3</td><td>9</td></tr>
      <tr><td>J</td><td>4</td><td>5</td></tr></table>"""
    rows = extract_html_tables(pages(spark, html)).collect()
    got = {(r.instituto_texto, r.periodo_texto, r.coluna_candidato, r.valor_texto) for r in rows}
    assert got == {
        ("I", "27 mar", "Nomes A", "1"), ("I", "27 mar", "Nomes A.1", "2"), ("I", "27 mar", "Nomes B", "3"),
        ("I", "27 mar", "", "9"), ("J", "27 mar", "Nomes A", "4"), ("J", "27 mar", "Nomes A.1", "5"),
        ("J", "27 mar", "Nomes B", ""), ("J", "27 mar", "", ""),
    }


def test_single_header_row_and_nested_tables(spark):
    html = """<table class="wikitable"><tr><th>Pesquisa</th><th>Período</th><th></th><th>Margem</th></tr>
      <tr><td>I<table class="wikitable"><tr><td>in</td></tr></table></td><td>a &amp; b</td><td>7</td><td>2</td></tr></table>"""
    rows = extract_html_tables(pages(spark, html, "<p>none</p>")).collect()
    assert [(r.instituto_texto, r.periodo_texto, r.coluna_candidato, r.valor_texto, r.margem_texto, r.amostra_texto)
            for r in rows] == [("I", "a & b", "Unnamed: 2", "7", "2", "")]


def test_tables_without_roles_or_cells_are_skipped(spark):
    html = ('<table class="wikitable"><tr><th>Instituto</th><th>X</th></tr><tr><td>1</td><td>2</td></tr></table>'
            '<table class="wikitable"><tr><th>Instituto</th><th>Data</th></tr><tr><td>1</td><td>2</td></tr></table>'
            '<table class="wikitable"><tr><td>no</td><td>header</td></tr></table>')
    assert read_table_rows(pages(spark, html)).count() == 3
    assert extract_html_tables(pages(spark, html)).count() == 0
    assert flat_headers(F.col("h")) is not None


def test_zip_members(spark, tmp_path):
    def archive(name, members):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            for member, text in members.items():
                z.writestr(member, text.encode("latin-1"))
        (tmp_path / name).write_bytes(buffer.getvalue())

    archive("a.zip", {"um.csv": 'A; B \n"x;1";\n"á";NA\n', "dois.CSV": "B\n7\n", "nota.txt": "?"})
    got = {(r.A, r.B, r[ORIGIN_COLUMN]) for r in read_zipped_csv(spark, str(tmp_path), ["A", "B"]).collect()}
    assert got == {("x;1", "", "um.csv"), ("á", "NA", "um.csv"), ("", "7", "dois.CSV")}
    archive("b.zip", {"nota.txt": "?"})
    with pytest.raises(Exception, match="no CSV member"):
        read_zipped_csv(spark, str(tmp_path), ["A", "B"]).collect()


def test_a_member_of_an_archive_is_a_task(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "two.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for name in ("a.csv", "b.csv"):
            z.writestr(name, "k;v\n" + "".join(f"{i};{name}\n" for i in range(30_000)))
    (tmp_path / "sub").mkdir()
    with zipfile.ZipFile(tmp_path / "sub" / "one.zip", "w") as z:
        z.writestr("c.csv", 'v;w\n"x\ny";1\n\n')
    df = read_zipped_csv(spark, str(tmp_path))
    assert df.columns == ["k", "v", "w", ORIGIN_COLUMN] and df.rdd.getNumPartitions() == 3
    assert df.count() == 60_001 and df.where("w = '1'").first().v == "x\ny"
    only = df.where(F.col(ORIGIN_COLUMN) == "a.csv")
    assert only.rdd.getNumPartitions() == 1 and only.count() == 30_000
    some = spark.read.format("zipped_csv").option("columns", "v").load(f"file://{tmp_path}/two.zip")
    assert some.columns == ["v", ORIGIN_COLUMN] and some.count() == 60_000
    assert sorted(map(tuple, read_zipped_csv(spark, str(tmp_path / "sub")).collect())) == sorted(
        map(tuple, read_zipped_csv(spark, str(tmp_path / "sub"), by_member=False).collect()))


def test_column_names():
    names = ["a b", "A (b)", "a_b", "", "  ", "_x", "c,;d="]
    assert clean_column_names(names) == ["a_b", "A_b_2", "a_b_3", "coluna", "coluna_2", "_x", "c_d"]


def test_empty_extract_is_refused(spark):
    with pytest.raises(ValueError, match="no rows"):
        land_table(spark.range(0), scratch_path(spark, "raw"), "empty")


def test_sources_and_seeds(spark, tmp_path):
    assert select_sources({"a": None, "b": None}, None) == ["a", "b"]
    with pytest.raises(ValueError, match="unknown"):
        select_sources({"a": None}, "a, z")
    (tmp_path / "s.csv").write_text("nm_candidato,ds_observacao\nZé,\n", encoding="utf-8")
    assert read_seed(spark, str(tmp_path), REGISTERED_CANDIDATES_SCHEMA).collect() == [("Zé", None)]


def test_layers(spark):
    assert database_name("marts", "me", True) == "marts"
    assert database_name("marts", "me", False) == "me_marts"
    assert database_name(None, "me", True) == "me"
    assert is_production("prod") and is_production("dev", "PROD") and not is_production("dev")
    assert LAYERS["staging"].stored_as == "view" and NOTICE_DAYS == 5
    name = materialise(spark.range(3), "staging", "t", "me", False)
    assert spark.table(name).count() == 3
    with pytest.raises(ValueError, match="buckets"):
        materialise(spark.range(3), "staging", "t", "me", False, buckets=4)
    for rows in (3, 5):
        mart = materialise(spark.range(rows), "marts", "t", "me", False, keys=["id"], buckets=2)
        assert mart == "me_marts.t" and spark.table(mart).count() == rows


def test_block_limit(spark):
    lines = spark.createDataFrame([(2, "b"), (1, "a")], "nr_ordem long, linha string")
    assert block_text(lines, "block").first()["block"] == "a\nb"


def test_lines_of_a_declared_block_are_counted(spark):
    block = spark.createDataFrame([("a;b;c;",), ("a;b;c",), ("a;b;c;d;e",), ("",)], "linha string")
    assert {(r.linha, r.fields) for r in wrong_lines(block, 4).collect()} == {("a;b;c", 3), ("a;b;c;d;e", 5), ("", 1)}
    right = spark.createDataFrame([("a;b;c;",)], "linha string")
    good = parse_block(right, "painel_institutos_mes", ["w", "x", "y", "z"])
    assert tuple(good.first()) == ("a", "b", "c", "")
    with pytest.raises(Exception, match="does not have 4 fields"):
        parse_block(block, "painel_institutos_mes", ["w", "x", "y", "z"]).collect()
    with pytest.raises(ValueError, match="has 4 fields"):
        parse_block(block, "painel_institutos_mes", ["w"])


def test_history_before_its_first_state_is_empty(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, v string").schema
    assert read_history(spark, str(tmp_path / "none"), schema).count() == 0


def test_malformed_lines_fail_and_line_breaks_stay(spark, tmp_path):
    (tmp_path / "ok.csv").write_text('a;b;c\n1;"x\ny";3\n', encoding="latin-1")
    assert [tuple(r)[:3] for r in read_delimited_text(spark, str(tmp_path / "ok.csv")).collect()] == [("1", "x\ny", "3")]
    for name, line in (("wide.csv", "2;p;q;extra"), ("short.csv", "2;p")):
        (tmp_path / name).write_text(f"a;b;c\n1;x;3\n{line}\n", encoding="latin-1")
        with pytest.raises(Exception):
            read_delimited_text(spark, str(tmp_path / name)).collect()


def test_member_columns_are_found_and_loss_is_an_error(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one.csv", "A;B\n1;2\n")
        z.writestr("two.csv", "A;NEW\n3;4\n")
    got = {(r.A, r.B, r.NEW) for r in read_zipped_csv(spark, str(tmp_path)).collect()}
    assert got == {("1", "2", ""), ("3", "", "4")}
    with pytest.raises(Exception, match="not listed"):
        read_zipped_csv(spark, str(tmp_path), ["A", "B"]).collect()
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one.csv", "A;B\n1;2;3\n")
    with pytest.raises(Exception, match="has 3 values"):
        read_zipped_csv(spark, str(tmp_path)).collect()


def test_broken_pages_keep_their_tables(spark):
    table = ('<table class="wikitable"><tr><th>Instituto</th><th>Data</th><th>A</th></tr>'
             '<tr><td rowspan="²">I</td><td colspan="{span}">d</td><td>1</td></tr></table>')
    rows = extract_html_tables(pages(spark, "<![foo[x]]>" + table.format(span=1), table.format(span=2_000_000))).collect()
    assert {(r.page_id, r.instituto_texto, r.valor_texto) for r in rows if r.coluna_candidato == "A"} == {(0, "I", "1"), (1, "I", "d")}


def test_calendar(spark):
    days = calendar_dimension(calendar_bounds(spark))
    assert days.count() == 1826
    row = days.filter("dt_data = date'2026-10-04'").first()
    assert (row.nr_dias_ate_1t, row.nr_dias_ate_2t, row.ds_mes_abrev) == (0, 21, "Oct")


def test_spread_leaves_wide_scans_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, cores * 2)
    assert spread(wide) is wide and spread(spark.range(0, 9, 1, 1)).rdd.getNumPartitions() == cores


def greedy(stamps, ttl):
    counted, last = [], None
    for stamp in sorted(stamps):
        if last is None or stamp >= last + ttl:
            counted.append(stamp)
            last = stamp
    return counted


def test_devices_are_counted_again_only_after_the_wait(spark):
    rng = random.Random(5)
    start, ttl = datetime.datetime(2024, 1, 1), datetime.timedelta(days=400)
    ids = ["hot-device"] * 5 + ["DEVICE-ABC", "other-one", "short", "bad id!!!"]
    visits = [(rng.choice(ids), start + datetime.timedelta(days=rng.randint(0, 2000))) for _ in range(600)]
    visits += [("exact-one", start), ("exact-one", start + ttl), ("exact-one", start + ttl - datetime.timedelta(seconds=1))]
    df = spark.createDataFrame(visits, "id string, ts timestamp")
    assert valid_visits(df).select("id").distinct().count() == 4
    expected = {(i, t) for i in ("hot-device", "DEVICE-ABC", "other-one", "exact-one")
                for t in greedy([t for j, t in visits if j == i], ttl)}
    assert {(r.id, r.counted_at) for r in count_devices_batch(df).collect()} == expected
