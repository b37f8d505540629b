import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tallyloom.functions import classify as K, cleaning as C, lines as L, measures as M, periods as P


def values(spark, texts, make, schema="t string"):
    df = spark.createDataFrame([(t,) for t in texts], schema)
    return [row[0] for row in df.select(make(F.col("t"))).collect()]


def test_null_sentinels(spark):
    got = values(spark, [None, "", "  ", " #NULO# ", "#NE", " a   b "], C.null_sentinels)
    assert got == [None, None, None, None, None, "a b"]


def test_locale_decimal_drops_every_dot(spark):
    got = values(spark, ["96.380,00", "96380.50", "-1", "x", " #NULO# "], C.locale_decimal)
    assert got == [Decimal("96380.00"), Decimal("9638050.00"), None, None, None]


def test_positive_int_and_fractions(spark):
    texts = ["2.000", "2000,00", "0", "-3"]
    assert values(spark, texts, C.positive_int) == [2000, None, None, None]
    lenient = values(spark, texts, lambda c: C.positive_int(c, allow_fraction=True))
    assert lenient == [2000, 2000, None, None]


def test_timestamp_formats(spark):
    texts = ["2026-09-01 10:00:00", "2026-09-01", "01/09/2026 10:00:00", "01/09/2026", "31/02/2026", "x", None]
    got = values(spark, texts, C.multi_format_timestamp)
    day, hour = datetime.datetime(2026, 9, 1), datetime.datetime(2026, 9, 1, 10)
    assert got == [hour, day, hour, day, None, None, None]


def test_first_number(spark):
    assert values(spark, ["± 2,0 p.p.", "<1", "45,2%", "-", None], C.first_number) == [
        Decimal("2.00"), Decimal("1.00"), Decimal("45.20"), None, None
    ]


def test_strip_markup(spark):
    texts = [
        "Quaest[17]", "Quaest[34][35]", 'Some Nameref name="X9">«...»</ref>', "<b>A</b>  B",
        "A [nota 1] B", 'A<ref group="x">long', "kept<ref>gone\nafter",
    ]
    assert values(spark, texts, C.strip_markup) == [
        "Quaest", "Quaest", "Some Name", "A B", "A B", "A", "kept<ref>gone\nafter".replace("<ref>", "")
    ]


def test_name_key_keeps_accents_and_fold_key_does_not(spark):
    texts = ["Futura/Apex", "apex futura", "Paraná  Pesquisas", "Parana Pesquisas", "...", ""]
    assert values(spark, texts, C.name_key) == [
        "apex|futura", "apex|futura", "paraná|pesquisas", "parana|pesquisas", "", ""
    ]
    assert values(spark, ["Veritá & Cia.", "..."], C.fold_key) == ["veritacia", ""]


def test_confidence_level(spark):
    texts = ["nível de confiança de 95%", "95,0% de confiança", "sem", "99% . confiança"]
    assert values(spark, texts, C.confidence_level) == [95, 95, None, None]


def test_titles_and_names(spark):
    title = lambda c: C.title_from_column_name(c, "_PE")
    assert values(spark, ["FELIPE_D'AVILA_PE"], title) == ["Felipe D'avila"]


def period(spark, text, reference):
    df = spark.createDataFrame([(text, reference)], "t string, r date").select(
        P.period_days(F.col("t")).alias("d"), P.period_months(F.col("t")).alias("m"), "r"
    )
    return tuple(df.select(*[
        P.roll_back_future(P.period_boundary(F.col("d"), F.col("m"), at, F.col("r")), F.col("r"))
        for at in (1, -1)
    ]).first())


def test_periods(spark):
    day = datetime.date
    load = day(2026, 10, 2)
    assert period(spark, "27 Mar - 29 Mar", load) == (day(2026, 3, 27), day(2026, 3, 29))
    assert period(spark, "27-29 mar", load) == (day(2026, 3, 27), day(2026, 3, 29))
    assert period(spark, "27-29 mar 2026", load) == (day(2026, 3, 27), day(2026, 3, 26))
    assert period(spark, "28 Dez - 2 Jan", day(2026, 1, 5)) == (day(2025, 12, 28), day(2026, 1, 2))
    assert period(spark, "28 - 2 abr", load) == (day(2026, 4, 28), day(2026, 4, 2))
    assert period(spark, "29 fev", load) == (None, None)
    assert period(spark, "29 fev", day(2024, 2, 1)) == (day(2023, 2, 28), day(2023, 2, 28))
    assert period(spark, "27", load) == (None, None)


def test_methods_match_whole_words(spark):
    texts = ["questionário estruturado", "via URA", "CATI", "painel web", "ponto de fluxo", None]
    assert values(spark, texts, K.classify_method) == [
        "Não classificada", "Telefônica automatizada (URA)", "Telefônica com entrevistador",
        "Web / painel online", "Presencial", "Não classificada",
    ]


def test_answers(spark):
    texts = ["Header 2", "Vantagem", "Indecisos e Absentos", "Não sabe", "Lula PT"]
    assert values(spark, texts, K.classify_answer) == [
        "Artefato", "Artefato", "Não-resposta", "Não-resposta", "Candidato"
    ]


def test_split_trailing_token(spark):
    texts = ["Lula PT", "Lima Sem partido", "Tereza C. PP", "Single"]
    assert values(spark, texts, lambda c: K.split_trailing_token(c)[0]) == [
        "Lula", "Lima", "Tereza C.", "Single"
    ]
    assert values(spark, texts, lambda c: K.split_trailing_token(c)[1]) == [
        "PT", "Sem partido", "PP", None
    ]


def test_flags_are_three_valued(spark):
    df = spark.createDataFrame([(None, True), (None, False), (False, False)], "a boolean, b boolean")
    assert [r[0] for r in df.select(K.any_alert(F.col("a"), F.col("b"))).collect()] == [True, None, False]


def test_measures(spark):
    df = spark.createDataFrame([(100, Decimal("10.00")), (0, Decimal("1.00"))], "n int, v decimal(18,2)")
    cost = [r[0] for r in df.select(M.cost_per_unit(F.col("v"), F.col("n"))).collect()]
    assert cost == [Decimal("0.100000"), None]
    margin = [r[0] for r in df.select(M.theoretical_margin(F.col("n"))).collect()]
    assert margin[0] == 0.098 and margin[1] is None


def test_lines_keep_positions(spark):
    df = spark.createDataFrame([("a", None, "c;d")], "a string, b string, c string")
    line = L.render_line(F.col("a"), F.col("b"), L.without_separator(F.col("c")))
    out = df.select(line.alias("l")).select("l", *[L.line_field(F.col("l"), i) for i in (1, 2, 3)]).first()
    assert tuple(out) == ("a;;c,d", "", "c,d", None)
