"""Raw poll tables derived from orders and their lines, and the typed rows they stand for.

Every order is a registered poll of the customer's segment and nation; its lines are the answers
of the same poll as a web table shows them, with other spellings and no year.
"""

from pyspark.sql import functions as F

from tallyloom.queries import shared_table, table

# Valid in both dialects.  All days fall in the year before the load.
BASE = """base AS (
  SELECT o_orderkey AS k, n_nationkey AS nk, n_name AS nation, c_mktsegment AS seg, o_totalprice AS price,
    make_date(CASE WHEN month(o_orderdate) > 8 OR (month(o_orderdate) = 8 AND day(o_orderdate) > 5)
      THEN 2000 ELSE 2001 END, month(o_orderdate), least(day(o_orderdate), 28)) AS d
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""

_TITLE = """array_to_string(list_transform(string_split(lower({0}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"""

# What the raw polls mean, straight from the typed tables.
POLLS_SQL = BASE + f""",
gen AS (
  SELECT *, 'BR' || lpad(CAST(k AS VARCHAR), 9, '0') AS protocol,
    CASE k % 3 WHEN 1 THEN 'SP' ELSE 'BR' END AS uf FROM base
  UNION ALL SELECT *, 'SP' || lpad(CAST(k AS VARCHAR), 9, '0'), 'SP' FROM base WHERE k % 40 = 0),
staged AS (
  SELECT protocol AS nr_protocolo_registro, CAST(NULL AS VARCHAR) AS cd_eleicao, 'Eleição Geral' AS nm_eleicao,
    uf AS sg_ue, CASE WHEN k % 4 = 3 THEN 'Governador' ELSE 'Presidente' END AS ds_cargo,
    CASE WHEN k % 4 <> 0 THEN 'Fantasia ' || nation END AS nm_empresa_fantasia,
    CAST(k % 100 AS VARCHAR) AS cd_conre, 'Resp ' || CAST(k % 7 AS VARCHAR) AS nm_estatistico_resp,
    CASE k % 6 WHEN 0 THEN 'questionário estruturado' WHEN 1 THEN 'sistema URA' WHEN 2 THEN 'CATI'
      WHEN 3 THEN 'painel web' WHEN 4 THEN 'visita domiciliar' END AS ds_metodologia_pesquisa,
    CASE k % 3 WHEN 0 THEN 'Nível de confiança de 95%.' WHEN 1 THEN '99,0% de confiança' ELSE 'Sem nível' END AS ds_plano_amostral,
    'controle' AS ds_sistema_controle, CAST(NULL AS VARCHAR) AS ds_dado_municipio,
    uf AS sg_uf, CASE uf WHEN 'SP' THEN 'SÃO PAULO' ELSE 'BRASIL' END AS nm_ue, seg || ' ' || nation AS nm_empresa,
    CASE k % 5 WHEN 0 THEN 'S' WHEN 1 THEN NULL ELSE 'N' END AS st_pesquisa_propria,
    d - 6 + CAST(k % 4 AS INTEGER) AS dt_registro, d - CAST(k % 3 AS INTEGER) AS dt_inicio_campo,
    d + CAST(k % 2 AS INTEGER) - CASE WHEN k % 31 = 0 THEN 5 ELSE 0 END AS dt_fim_campo,
    d + CAST(k % 6 AS INTEGER) - 1 AS dt_divulgacao, 2001 AS ano_eleicao,
    '123456780001' || lpad(CAST(nk AS VARCHAR), 2, '0') AS nr_cnpj_empresa,
    CAST(d - 6 + CAST(k % 4 AS INTEGER) AS TIMESTAMP) AS ts_registro,
    CASE WHEN k % 29 <> 0 AND k % 30 <> 1 THEN CAST(1000 + (k * 37) % 1500 AS INTEGER) END AS qt_entrevistados,
    CASE WHEN k % 24 = 1 THEN 0.00 WHEN k % 23 <> 0 THEN CAST(price AS DECIMAL(18,2)) END AS vr_pesquisa,
    TIMESTAMP '2001-09-01 10:00:00' AS ts_geracao_arquivo_tse, TIMESTAMP '2001-09-01 12:00:00' AS _ingerido_em,
    'polls.csv' AS _arquivo_origem FROM gen),
classified AS (
  SELECT *, coalesce(nm_empresa_fantasia, {_TITLE.format("nm_empresa")}) AS nm_instituto,
    CASE st_pesquisa_propria WHEN 'S' THEN 'Própria' WHEN 'N' THEN 'Contratada' END AS tp_contratacao,
    CASE ds_metodologia_pesquisa WHEN 'sistema URA' THEN 'Telefônica automatizada (URA)' WHEN 'CATI' THEN 'Telefônica com entrevistador'
      WHEN 'painel web' THEN 'Web / painel online' WHEN 'visita domiciliar' THEN 'Presencial' ELSE 'Não classificada' END AS tp_metodo_coleta,
    CAST(dt_divulgacao - dt_fim_campo AS INTEGER) AS nr_dias_campo_divulgacao,
    CAST(dt_divulgacao - dt_registro AS INTEGER) AS nr_dias_registro_divulgacao,
    CAST(dt_fim_campo - dt_inicio_campo + 1 AS INTEGER) AS nr_dias_campo, nm_ue = 'BRASIL' AS fl_abrangencia_nacional,
    qt_entrevistados IS NULL AS fl_dq_amostra_invalida, vr_pesquisa IS NULL OR vr_pesquisa = 0 AS fl_dq_valor_ausente,
    dt_inicio_campo > dt_fim_campo AS fl_dq_campo_invertido, dt_divulgacao < dt_fim_campo AS fl_dq_divulgacao_antes_fim_campo,
    dt_divulgacao - dt_registro < 5 AS fl_dq_registro_fora_prazo_legal, nm_empresa_fantasia IS NULL AS fl_dq_sem_nome_fantasia FROM staged),
polls AS (
  SELECT *, fl_dq_amostra_invalida OR fl_dq_valor_ausente OR fl_dq_campo_invertido OR fl_dq_divulgacao_antes_fim_campo
    OR fl_dq_registro_fora_prazo_legal AS fl_dq_possui_alerta FROM classified)"""


def _views(spark, sf_dir):
    for name in ("customer", "nation"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    for name in ("orders", "lineitem"):
        shared_table(spark, sf_dir, name).createOrReplaceTempView(name)


def raw_polls(spark, sf_dir):
    """All-string registered polls; some protocols repeat with an older generation."""
    _views(spark, sf_dir)
    base = spark.sql(f"""WITH {BASE} SELECT *, explode(array_compact(array(
      'current', if(k % 10 = 0, 'older', null), if(k % 40 = 0, 'mirror', null)))) AS version FROM base""")
    k, d = F.col("k"), F.col("d")
    mirror, older = F.col("version") == "mirror", F.col("version") == "older"
    formats = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy")

    def shown(day):
        text = F.date_format(day, formats[0])
        for i, fmt in enumerate(formats[1:], 1):
            text = F.when(k % 4 == i, F.date_format(day, fmt)).otherwise(text)
        return text

    def days(expression):
        return F.expr(f"cast({expression} as int)")

    number = k.cast("string")
    prefix = F.when(mirror, "SP").otherwise("BR")
    place = F.when(mirror | (k % 3 == 1), "SP").otherwise("BR")
    money = F.translate(F.format_number("price", 2), ",.", ".,")
    sample = F.translate(F.format_number(1000 + (k * 37) % 1500, 0), ",", ".")
    method = F.expr("""CASE k % 6 WHEN 0 THEN ' questionário  estruturado' WHEN 1 THEN 'sistema URA'
      WHEN 2 THEN 'CATI' WHEN 3 THEN 'painel web' WHEN 4 THEN 'visita domiciliar' ELSE '#NULO#' END""")
    plan = F.expr("""CASE k % 3 WHEN 0 THEN 'Nível de confiança de 95%.'
      WHEN 1 THEN '99,0% de confiança' ELSE 'Sem nível' END""")

    columns = {
        "NR_PROTOCOLO_REGISTRO": F.concat(prefix, F.lpad(number, 9, "0"), F.lit(" ")),
        "AA_ELEICAO": F.lit("2001"), "CD_ELEICAO": F.lit("#NULO"),
        "NM_ELEICAO": F.lit("Eleição   Geral"), "SG_UF": F.lower(place), "SG_UE": place,
        "NM_UE": F.when(place == "SP", "São Paulo").otherwise("Brasil"),
        "DS_CARGO": F.when(k % 4 == 3, "Governador").otherwise("Presidente"),
        "NR_CNPJ_EMPRESA": F.concat(F.lit("12.345.678/0001-"), F.lpad(F.col("nk").cast("string"), 2, "0")),
        "NM_EMPRESA": F.lower(F.concat_ws(" ", "seg", "nation")),
        "NM_EMPRESA_FANTASIA": F.when(k % 4 == 0, "#NULO#").otherwise(F.concat(F.lit("Fantasia "), "nation")),
        "CD_CONRE": (k % 100).cast("string"),
        "NM_ESTATISTICO_RESP": F.concat(F.lit("Resp "), (k % 7).cast("string")),
        "ST_PESQUISA_PROPRIA": F.when(k % 5 == 0, "s").when(k % 5 == 1, "#NE#").otherwise("N"),
        "DT_REGISTRO": shown(F.date_add(d, days("k % 4 - 6"))),
        "DT_INICIO_PESQUISA": shown(F.date_sub(d, days("k % 3"))),
        "DT_FIM_PESQUISA": shown(F.date_add(d, days("k % 2 - if(k % 31 = 0, 5, 0)"))),
        "DT_DIVULGACAO": shown(F.date_add(d, days("k % 6 - 1"))),
        "QT_ENTREVISTADO": F.when(k % 29 == 0, "0").when(k % 30 == 1, "-1").otherwise(sample),
        "VR_PESQUISA": F.when(older, "1,00").when(k % 24 == 1, "0,00").when(
            k % 23 == 0, "#NE"
        ).otherwise(money),
        "DS_METODOLOGIA_PESQUISA": method, "DS_PLANO_AMOSTRAL": plan,
        "DS_SISTEMA_CONTROLE": F.lit("controle"), "DS_DADO_MUNICIPIO": F.lit(""),
        "DT_GERACAO": F.when(older, "31/08/2001").otherwise("01/09/2001"), "HH_GERACAO": F.lit("10:00:00"),
        "_arquivo_origem": F.lit("polls.csv"),
        "_ingerido_em": F.lit("2001-09-01 12:00:00").cast("timestamp"), "_linha": k,
    }
    return base.select(*[column.alias(name) for name, column in columns.items()])


_MONTH_NAMES = ("Jan", "fev", "Mar", "abr", "mai", "jun", "jul", "ago", "set", "Out", "nov", "dez")


def raw_cells(spark, sf_dir):
    """All-string web-table cells: one row per order line."""
    _views(spark, sf_dir)
    base = spark.sql(f"""WITH {BASE} SELECT base.*, l_linenumber AS n, l_quantity AS q, l_discount AS disc, l_tax AS tax
      FROM base JOIN lineitem ON l_orderkey = k""")
    k, d = F.col("k"), F.col("d")
    start, end = F.date_sub(d, F.expr("cast(k % 3 as int)")), F.date_add(d, F.expr("cast(k % 2 as int)"))
    months = F.array(*[F.lit(m) for m in _MONTH_NAMES])

    def shown(day):
        return F.concat(F.day(day).cast("string"), F.lit(" "), F.element_at(months, F.month(day)))

    sample = F.translate(F.format_number(1000 + (k * 37) % 1500 + (k % 5) * 10, 0), ",", ".")
    return base.select(
        (k % 5).cast("string").alias("tabela_idx"),
        F.expr("""CASE k % 4 WHEN 0 THEN seg || ' ' || nation || '[12]' WHEN 1 THEN lower(seg || ' ' || nation)
          WHEN 2 THEN nation || '/' || seg ELSE seg || '   ' || nation END""").alias("instituto_texto"),
        F.when(k % 50 == 7, F.expr("nation || '/' || seg")).otherwise(
            F.concat_ws(" - ", shown(start), shown(end))
        ).alias("periodo_texto"),
        F.when(k % 8 == 7, "").otherwise(F.concat(sample, F.lit("[3]"))).alias("amostra_texto"),
        F.concat(F.lit("± "), (k % 4).cast("string"), F.lit(",5 p.p.")).alias("margem_texto"),
        F.expr("""CASE n WHEN 1 THEN 'Alfa PA' WHEN 2 THEN 'Beta   PB' WHEN 3 THEN 'Gama Sem partido'
          WHEN 4 THEN 'Indecisos' WHEN 5 THEN 'Delta' WHEN 6 THEN 'Vantagem' ELSE 'Epsilon PE[1]' END""").alias("coluna_candidato"),
        F.expr("""CASE WHEN disc >= 0.095 THEN '120' WHEN tax < 0.005 THEN ''
          ELSE cast(cast(q as int) as string) || ',5%' END""").alias("valor_texto"),
        F.lit("2001-08-06 10:00:00").cast("timestamp").alias("_ingerido_em"),
    )


CELLS_SQL = BASE + """,
line AS (SELECT base.*, l_linenumber AS n, l_quantity AS q, l_discount AS disc, l_tax AS tax,
    d - CAST(k % 3 AS INTEGER) AS s, d + CAST(k % 2 AS INTEGER) AS e FROM base JOIN lineitem ON l_orderkey = k),
cells AS (
  SELECT CAST(k % 5 AS INTEGER) AS tabela_idx,
    CASE k % 4 WHEN 1 THEN lower(seg || ' ' || nation) WHEN 2 THEN nation || '/' || seg ELSE seg || ' ' || nation END AS nm_instituto_origem,
    CAST(day(s) AS VARCHAR) || ' ' || (['Jan','fev','Mar','abr','mai','jun','jul','ago','set','Out','nov','dez'])[month(s)] || ' - '
      || CAST(day(e) AS VARCHAR) || ' ' || (['Jan','fev','Mar','abr','mai','jun','jul','ago','set','Out','nov','dez'])[month(e)] AS periodo_texto,
    make_date(CASE WHEN make_date(2001, month(s), day(s)) > DATE '2001-08-06' THEN 2000 ELSE 2001 END, month(s), day(s)) AS dt_inicio_campo,
    make_date(CASE WHEN make_date(2001, month(e), day(e)) > DATE '2001-08-06' THEN 2000 ELSE 2001 END, month(e), day(e)) AS dt_fim_campo,
    CASE WHEN k % 8 <> 7 THEN CAST(1000 + (k * 37) % 1500 + (k % 5) * 10 AS INTEGER) END AS qt_amostra,
    CAST(k % 4 + 0.5 AS DECIMAL(5,2)) AS pc_margem_erro,
    CASE n WHEN 1 THEN 'Alfa PA' WHEN 2 THEN 'Beta PB' WHEN 3 THEN 'Gama Sem partido' WHEN 4 THEN 'Indecisos' WHEN 5 THEN 'Delta' ELSE 'Epsilon PE' END AS coluna_candidato,
    CASE n WHEN 4 THEN 'Não-resposta' ELSE 'Candidato' END AS tp_resposta,
    CAST(CAST(q AS INTEGER) + 0.5 AS DECIMAL(9,2)) AS pc_valor, TIMESTAMP '2001-08-06 10:00:00' AS _ingerido_em
  FROM line WHERE n <> 6 AND disc < 0.095 AND tax >= 0.005 AND NOT (k % 50 = 7 AND k % 4 = 2) AND k % 50 <> 7)"""

_KEY = """array_to_string(list_sort(list_filter(string_split(
  lower(regexp_replace({0}, '[^A-Za-z0-9À-ÿ]', ' ', 'g')), ' '), lambda w: w <> '')), '|')"""

FACT_SQL = CELLS_SQL + f""",
spelling AS (SELECT nm_instituto_origem AS o, {_KEY.format("nm_instituto_origem")} AS key, count(*) AS uses FROM cells GROUP BY 1, 2),
canon AS (SELECT o, key, first_value(o) OVER (PARTITION BY key ORDER BY uses DESC, o) AS canonical FROM spelling),
named AS (
  SELECT c.*, CASE canon.key WHEN '3|building|nation' THEN 'Grupo Três' WHEN '7|machinery|nation' THEN 'Grupo Sete' ELSE canonical END AS nm_instituto,
    CASE coluna_candidato WHEN 'Alfa PA' THEN 'Alfa' WHEN 'Beta PB' THEN 'Beta' WHEN 'Gama Sem partido' THEN 'Gama' WHEN 'Delta' THEN 'Delta' WHEN 'Epsilon PE' THEN 'Epsilon' END AS nm_candidato_origem,
    CASE coluna_candidato WHEN 'Alfa PA' THEN 'PA' WHEN 'Beta PB' THEN 'PB' WHEN 'Gama Sem partido' THEN 'Sem partido' WHEN 'Epsilon PE' THEN 'PE' END AS sg_partido
  FROM cells c JOIN canon ON canon.o = c.nm_instituto_origem),
mapped AS (
  SELECT *, CASE nm_candidato_origem WHEN 'Alfa' THEN 'Alfa Silva' WHEN 'Gama' THEN 'Gama (Sem partido)' ELSE coalesce(nm_candidato_origem, coluna_candidato) END AS nm_candidato,
    coalesce(nm_candidato_origem <> 'Alfa', false) AS fl_candidato_revisar,
    sha256(concat_ws('|', nm_instituto, CAST(dt_inicio_campo AS VARCHAR), CAST(dt_fim_campo AS VARCHAR), CAST(coalesce(qt_amostra, 0) AS VARCHAR))) AS id_pesquisa FROM named),
sets AS (SELECT tabela_idx AS t, id_pesquisa AS p, string_agg(DISTINCT nm_candidato, ',' ORDER BY nm_candidato) AS members FROM mapped GROUP BY 1, 2),
ranked AS (
  SELECT m.*, sha256(id_pesquisa || '|' || members) AS id_cenario, row_number() OVER (PARTITION BY sha256(id_pesquisa || '|' || members), nm_candidato
    ORDER BY tabela_idx, nm_instituto_origem, periodo_texto, coluna_candidato, pc_valor, pc_margem_erro) AS rn
  FROM mapped m JOIN sets ON t = tabela_idx AND p = id_pesquisa),
fact AS (SELECT id_pesquisa, id_cenario, nm_instituto, nm_instituto_origem, dt_inicio_campo, dt_fim_campo, periodo_texto, qt_amostra, pc_margem_erro,
    tp_resposta, nm_candidato, nm_candidato_origem, sg_partido, fl_candidato_revisar, pc_valor AS pc_intencao_voto, _ingerido_em FROM ranked WHERE rn = 1)"""


def lookups(spark):
    """The four small lookup tables, shaped like seed files."""
    institutes = spark.createDataFrame(
        [("Building nation_3", "Grupo Três", False), ("NATION_7 machinery", "Grupo Sete", True)],
        "nm_instituto_origem string, nm_instituto_padronizado string, revisar boolean",
    )
    candidates = spark.createDataFrame(
        [("wikipedia", "Alfa", "PA", "Alfa Silva", False),
         ("wikipedia", "Gama", "Sem partido", "Gama (Sem partido)", True),
         ("wikipedia", "Delta", None, "never matches", False),
         ("tse_2022", "Alpha One", None, "Alpha 1", False)],
        "fonte string, nm_candidato_origem string, sg_partido_origem string, "
        "nm_candidato_padronizado string, revisar boolean",
    )
    registered = spark.createDataFrame(
        [("Alfa Silva", "x"), ("Beta", "x"), ("Gama (Sem partido)", "x"), ("Delta", "x")],
        "nm_candidato string, ds_observacao string",
    )
    patterns = spark.createDataFrame(
        [("Grupo Três", "buildingnation3f|machinerynation3"), ("Grupo Sete", "machinerynation7")],
        "inst_ok string, chave_tse string",
    )
    return institutes, candidates, registered, patterns
