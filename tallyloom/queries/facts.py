"""From raw tables to facts and dimensions."""

from pyspark.sql import functions as F

from tallyloom.plans import official_results as R, registered_polls as P, voting_intention as V
from tallyloom.queries import query, table
from tallyloom.queries.sources_of_facts import (
    CELLS_SQL, FACT_SQL, POLLS_SQL, lookups, raw_cells, raw_polls,
)

_MICRO = {
    "vr_custo_por_entrevista": "CAST(CASE WHEN qt_entrevistados > 0 THEN CAST((2 * CAST(vr_pesquisa * 100 AS HUGEINT) + qt_entrevistados) // (2 * qt_entrevistados) AS DECIMAL(18,2)) / 100 END AS DECIMAL(18,2)) AS vr_custo_por_entrevista",
    "pc_margem_erro_teorica": "CAST(round(0.98 / sqrt(qt_entrevistados), 6) AS DECIMAL(9,6)) AS pc_margem_erro_teorica",
}


def _rounded(df):
    """Quotients at a fixed scale, so both engines can be compared."""
    return df.withColumns({
        "vr_custo_por_entrevista": F.round("vr_custo_por_entrevista", 2).cast("decimal(18,2)"),
        "pc_margem_erro_teorica": F.round("pc_margem_erro_teorica", 6).cast("decimal(9,6)"),
    })


@query("staged_polls", f"WITH {POLLS_SQL} SELECT * FROM staged")
def staged_polls(spark, sf_dir):
    return P.stage_polls(raw_polls(spark, sf_dir))


def _classified(spark, sf_dir):
    return P.classify_polls(P.stage_polls(raw_polls(spark, sf_dir)))


@query("polls_fact", f"""WITH {POLLS_SQL} SELECT {", ".join(_MICRO.get(c, c) for c in P.FACT_COLUMNS)} FROM polls""")
def polls_fact(spark, sf_dir):
    return _rounded(P.polls_fact(_classified(spark, sf_dir)))


@query("polls_with_alerts", f"""
WITH {POLLS_SQL} SELECT nr_protocolo_registro, nm_instituto, dt_registro, dt_inicio_campo, dt_fim_campo, dt_divulgacao, qt_entrevistados, vr_pesquisa,
  {", ".join(P.ALERT_FLAGS)} FROM polls WHERE fl_dq_possui_alerta""")
def polls_with_alerts(spark, sf_dir):
    return P.polls_with_alerts(P.polls_fact(_classified(spark, sf_dir)))


@query("institute_dimension", f"""
WITH {POLLS_SQL}, g AS (SELECT nr_cnpj_empresa, nm_instituto, nm_empresa, count(*) AS n, min(dt_registro) AS a, max(dt_registro) AS b FROM polls GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY nr_cnpj_empresa ORDER BY n DESC, nm_instituto, nm_empresa) AS rn,
  sum(n) OVER w AS total, min(a) OVER w AS first_day, max(b) OVER w AS last_day FROM g WINDOW w AS (PARTITION BY nr_cnpj_empresa))
SELECT nr_cnpj_empresa, nm_instituto, nm_empresa, CAST(total AS BIGINT) AS qt_pesquisas_registradas,
  first_day AS dt_primeiro_registro, last_day AS dt_ultimo_registro FROM r WHERE rn = 1""")
def institute_dimension(spark, sf_dir):
    return P.institute_dimension(_classified(spark, sf_dir))


@query("staged_cells", f"WITH {CELLS_SQL} SELECT * FROM cells")
def staged_cells(spark, sf_dir):
    return V.stage_cells(raw_cells(spark, sf_dir))


def intention(spark, sf_dir):
    institutes, candidates, _, _ = lookups(spark)
    cells = V.stage_cells(raw_cells(spark, sf_dir))
    return V.intention_fact(V.standardise(cells, institutes, candidates))


@query("intention_fact", f"WITH {FACT_SQL} SELECT * FROM fact")
def intention_fact(spark, sf_dir):
    return intention(spark, sf_dir)


@query("scenarios_off_balance", f"""
WITH {FACT_SQL} SELECT id_cenario, nm_instituto, dt_fim_campo, CAST(sum(pc_intencao_voto) AS DECIMAL(19,2)) AS pc_soma FROM fact
GROUP BY 1, 2, 3 HAVING sum(pc_intencao_voto) NOT BETWEEN 90 AND 110""")
def scenarios_off_balance(spark, sf_dir):
    return V.scenarios_off_balance(intention(spark, sf_dir))


_RESULTS_SQL = """
w AS (SELECT CAST(event_id % 5 AS VARCHAR) || 'T' AS turno, ts, value, user_id, event_type FROM events),
u AS (
  SELECT date_trunc('second', ts) AS t, CAST(event_id % 2 + 1 AS INTEGER) AS r, 'ALPHA_ONE_PE_VOTOS_TOT_ACUMULADO' AS col, CAST(CAST(value AS DECIMAL(18,2)) / 1000 AS DECIMAL(12,8)) AS f FROM events
  UNION ALL SELECT date_trunc('second', ts), CAST(event_id % 2 + 1 AS INTEGER), 'BETA_PE_VOTOS_TOT_ACUMULADO', CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS DECIMAL(12,8)) / 100000 END FROM events)"""


@query("staged_results", f"""
WITH {_RESULTS_SQL} SELECT t AS ts_totalizacao, CAST(t AS DATE) AS dt_totalizacao, r AS nr_turno, col AS coluna_origem,
  CASE col WHEN 'BETA_PE_VOTOS_TOT_ACUMULADO' THEN 'Beta' ELSE 'Alpha One' END AS nm_candidato_origem,
  CAST(f * 100 AS DECIMAL(9,4)) AS pc_votos_validos_acumulado, TIMESTAMP '2024-02-01' AS _ingerido_em FROM u WHERE f IS NOT NULL""")
def staged_results(spark, sf_dir):
    return R.stage_results(_raw_results(spark, sf_dir))


def _raw_results(spark, sf_dir):
    def shown(number):
        return F.concat(F.lit("   "), F.translate(number.cast("decimal(12,8)").cast("string"), ".", ","))

    events = table(spark, sf_dir, "events")
    value = F.col("value").cast("decimal(18,2)") / 1000
    even = F.col("event_id") % 2 == 0
    return events.select(
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("DT_TOTALIZACAO"),
        F.concat((F.col("event_id") % 2 + 1).cast("string"), F.lit("T")).alias("TURNO"),
        shown(value).alias("ALPHA_ONE_PE_VOTOS_TOT_ACUMULADO"),
        F.when(even, shown(F.col("user_id").cast("decimal(20,0)") / 100000)).otherwise("").alias(
            "Beta_PE_Votos_Tot_Acumulado"
        ),
        F.lit("0,5").alias("BRANCO_PE_VOTOS_TOT_ACUMULADO"), F.lit("0,5").alias("NULO_PE_VOTOS_TOT_ACUMULADO"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("_ingerido_em"),
    )


def results(spark, sf_dir):
    _, candidates, _, _ = lookups(spark)
    return R.results_fact(R.stage_results(_raw_results(spark, sf_dir)), candidates)


_RESULTS_FACT_SQL = _RESULTS_SQL + """,
f AS (SELECT t AS ts_totalizacao, CAST(t AS DATE) AS dt_totalizacao, r AS nr_turno,
  CASE col WHEN 'BETA_PE_VOTOS_TOT_ACUMULADO' THEN 'Beta' ELSE 'Alpha 1' END AS nm_candidato,
  CASE col WHEN 'BETA_PE_VOTOS_TOT_ACUMULADO' THEN 'Beta' ELSE 'Alpha One' END AS nm_candidato_origem,
  CAST(f * 100 AS DECIMAL(9,4)) AS pc_votos_validos_acumulado, t = max(t) OVER (PARTITION BY r) AS fl_resultado_final,
  TIMESTAMP '2024-02-01' AS _ingerido_em FROM u WHERE f IS NOT NULL)"""


@query("results_fact", f"WITH {_RESULTS_FACT_SQL} SELECT * FROM f")
def results_fact(spark, sf_dir):
    return results(spark, sf_dir)


@query("final_results_off_balance", f"""
WITH {_RESULTS_FACT_SQL} SELECT nr_turno, CAST(sum(pc_votos_validos_acumulado) AS DECIMAL(19,4)) AS pc_soma FROM f
WHERE fl_resultado_final GROUP BY 1 HAVING abs(sum(pc_votos_validos_acumulado) - 100) > 0.5""")
def final_results_off_balance(spark, sf_dir):
    return R.final_results_off_balance(results(spark, sf_dir))
