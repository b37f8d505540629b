"""Registered polls: typing, classification, fact and institute dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.classify import (
    any_alert, classify_method, code_label, quality_flags,
)
from tallyloom.functions.cleaning import (
    digits_only, display_name, locale_decimal, multi_format_timestamp, null_sentinels, positive_int,
)
from tallyloom.functions.measures import (
    cost_per_unit, day_gap, field_length, theoretical_margin,
)
from tallyloom.operators.entity import most_used_per_key
from tallyloom.operators.windows import first_per_key
from tallyloom.sinks.raw_tables import ROW_ID_COLUMN

NOTICE_DAYS = 5
# --- fixed values: raw column per output column, and the published fact --------------------
TEXT_COLUMNS = {
    "nr_protocolo_registro": "NR_PROTOCOLO_REGISTRO",
    "cd_eleicao": "CD_ELEICAO",
    "nm_eleicao": "NM_ELEICAO",
    "sg_ue": "SG_UE",
    "ds_cargo": "DS_CARGO",
    "nm_empresa_fantasia": "NM_EMPRESA_FANTASIA",
    "cd_conre": "CD_CONRE",
    "nm_estatistico_resp": "NM_ESTATISTICO_RESP",
    "ds_metodologia_pesquisa": "DS_METODOLOGIA_PESQUISA",
    "ds_plano_amostral": "DS_PLANO_AMOSTRAL",
    "ds_sistema_controle": "DS_SISTEMA_CONTROLE",
    "ds_dado_municipio": "DS_DADO_MUNICIPIO",
}
UPPER_COLUMNS = {
    "sg_uf": "SG_UF",
    "nm_ue": "NM_UE",
    "nm_empresa": "NM_EMPRESA",
    "st_pesquisa_propria": "ST_PESQUISA_PROPRIA",
}
DATE_COLUMNS = {
    "dt_registro": "DT_REGISTRO",
    "dt_inicio_campo": "DT_INICIO_PESQUISA",
    "dt_fim_campo": "DT_FIM_PESQUISA",
    "dt_divulgacao": "DT_DIVULGACAO",
}
NATIONAL_UNIT = "BRASIL"
ALERT_FLAGS = (
    "fl_dq_amostra_invalida", "fl_dq_valor_ausente", "fl_dq_campo_invertido",
    "fl_dq_divulgacao_antes_fim_campo", "fl_dq_registro_fora_prazo_legal",
)
FACT_COLUMNS = (
    "nr_protocolo_registro", "ano_eleicao", "nm_eleicao", "ds_cargo", "sg_uf", "sg_ue", "nm_ue",
    "fl_abrangencia_nacional", "nr_cnpj_empresa", "nm_instituto", "nm_empresa", "tp_contratacao",
    "tp_metodo_coleta", "nm_estatistico_resp", "cd_conre", "dt_registro", "dt_inicio_campo",
    "dt_fim_campo", "dt_divulgacao", "nr_dias_campo", "nr_dias_campo_divulgacao",
    "nr_dias_registro_divulgacao", "qt_entrevistados", "vr_pesquisa", "vr_custo_por_entrevista",
    "pc_margem_erro_teorica", *ALERT_FLAGS, "fl_dq_sem_nome_fantasia", "fl_dq_possui_alerta",
    "ds_metodologia_pesquisa", "ds_plano_amostral", "ts_geracao_arquivo_tse", "_ingerido_em",
)
# -------------------------------------------------------------------------------------------


def _typed(raw: DataFrame) -> DataFrame:
    """Every raw text is cleaned once; the typed columns read the cleaned text."""
    sources = [
        "AA_ELEICAO", "NR_CNPJ_EMPRESA", "QT_ENTREVISTADO", "VR_PESQUISA",
        *TEXT_COLUMNS.values(), *UPPER_COLUMNS.values(), *DATE_COLUMNS.values(),
    ]
    generated = F.concat(F.col("DT_GERACAO"), F.lit(" "), F.col("HH_GERACAO"))
    texts = {f"t_{source}": null_sentinels(F.col(source)) for source in sources}
    # Plain columns, so that Spark drops those a reader does not ask for; a filter of a reader stays
    # above the choice of the row per protocol and repeats none of them.
    settled = raw.withColumns({**texts, "t_generated": null_sentinels(generated)})

    def text(source: str) -> Column:
        return F.col(f"t_{source}")

    def moment(source: str) -> Column:
        return multi_format_timestamp(text(source), cleaned=True)

    columns: dict[str, Column] = {}
    for name, source in TEXT_COLUMNS.items():
        columns[name] = text(source)
    for name, source in UPPER_COLUMNS.items():
        columns[name] = F.upper(text(source))
    for name, source in DATE_COLUMNS.items():
        columns[name] = F.to_date(moment(source))
    columns["ano_eleicao"] = text("AA_ELEICAO").try_cast("int")
    columns["nr_cnpj_empresa"] = digits_only(text("NR_CNPJ_EMPRESA"))
    columns["ts_registro"] = moment("DT_REGISTRO")
    columns["qt_entrevistados"] = positive_int(text("QT_ENTREVISTADO"), cleaned=True)
    columns["vr_pesquisa"] = locale_decimal(text("VR_PESQUISA"), cleaned=True)
    columns["ts_geracao_arquivo_tse"] = moment("generated")
    kept = ["_ingerido_em", "_arquivo_origem", *[c for c in raw.columns if c == ROW_ID_COLUMN]]
    return settled.select(*[column.alias(name) for name, column in columns.items()], *kept)


def stage_polls(raw: DataFrame) -> DataFrame:
    """One typed row per protocol: the most recently generated one.

    Ties beyond generation and load time go to the file name and then to the row id kept at
    landing.  Raw rows without ids are told apart by their whole content, so that a reader of a
    few columns still reads all of them.
    """
    typed = _typed(raw)
    by_id = ROW_ID_COLUMN in typed.columns
    last = F.asc(ROW_ID_COLUMN) if by_id else F.xxhash64(*typed.columns)
    first = first_per_key(
        typed, ["nr_protocolo_registro"],
        [
            F.desc_nulls_last("ts_geracao_arquivo_tse"), F.desc_nulls_last("_ingerido_em"),
            F.asc("_arquivo_origem"), last,
        ],
    )
    return first.drop(ROW_ID_COLUMN)


def classify_polls(polls: DataFrame, notice_days: int = NOTICE_DAYS) -> DataFrame:
    """Display name, labels, measures and quality flags; no row is removed."""
    sample, amount = F.col("qt_entrevistados"), F.col("vr_pesquisa")
    start, end = F.col("dt_inicio_campo"), F.col("dt_fim_campo")
    published, registered = F.col("dt_divulgacao"), F.col("dt_registro")
    derived = {
        "nm_instituto": display_name(F.col("nm_empresa_fantasia"), F.col("nm_empresa")),
        "tp_contratacao": code_label(F.col("st_pesquisa_propria")),
        "tp_metodo_coleta": classify_method(F.col("ds_metodologia_pesquisa")),
        "vr_custo_por_entrevista": cost_per_unit(amount, sample),
        "pc_margem_erro_teorica": theoretical_margin(sample),
        "nr_dias_campo_divulgacao": day_gap(published, end),
        "nr_dias_registro_divulgacao": day_gap(published, registered),
        "nr_dias_campo": field_length(start, end),
        "fl_abrangencia_nacional": F.col("nm_ue") == NATIONAL_UNIT,
        **quality_flags(
            sample, amount, start, end, published, registered, F.col("nm_empresa_fantasia"),
            notice_days,
        ),
    }
    return polls.withColumns(derived)


def polls_fact(classified: DataFrame) -> DataFrame:
    """The published columns, with one flag for any alert."""
    alert = any_alert(*[F.col(flag) for flag in ALERT_FLAGS])
    return classified.withColumn("fl_dq_possui_alerta", alert).select(*FACT_COLUMNS)


def institute_dimension(classified: DataFrame) -> DataFrame:
    """One row per company number with its most used names."""
    return most_used_per_key(
        classified.filter(F.col("nr_cnpj_empresa").isNotNull()),
        "nr_cnpj_empresa", ["nm_instituto", "nm_empresa"], "dt_registro",
        count="qt_pesquisas_registradas", first="dt_primeiro_registro", last="dt_ultimo_registro",
    )


def polls_with_alerts(fact: DataFrame) -> DataFrame:
    """The rows behind the alert check."""
    return fact.filter("fl_dq_possui_alerta").select(
        "nr_protocolo_registro", "nm_instituto", "dt_registro", "dt_inicio_campo", "dt_fim_campo",
        "dt_divulgacao", "qt_entrevistados", "vr_pesquisa", *ALERT_FLAGS,
    )
