"""Voting intention out of web-table cells: typing, names, keys, fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.classify import (
    ARTEFACT, CANDIDATE, classify_answer, split_trailing_token,
)
from tallyloom.functions.cleaning import digits_only, first_number, strip_markup
from tallyloom.functions.periods import (
    period_boundary, period_days, period_months, roll_back_future,
)
from tallyloom.operators.entity import canonical_spellings, lookup_by_name_key, with_canonical
from tallyloom.operators.joins import lookup_join
from tallyloom.operators.keys import content_key, content_text, with_member_set
from tallyloom.operators.quality import group_sum_outside
from tallyloom.operators.reshape import with_settled
from tallyloom.operators.windows import first_per_key
from tallyloom.session import durable

# --- fixed values ---------------------------------------------------------------------------
CELLS_ORIGIN = "wikipedia"
RAW_COLUMNS = (
    "tabela_idx", "instituto_texto", "periodo_texto", "amostra_texto", "margem_texto",
    "coluna_candidato", "valor_texto", "_ingerido_em",
)
SHARE_BOUNDS = (0, 100)
SCENARIO_SUM_BOUNDS = (90, 110)
FACT_COLUMNS = (
    "id_pesquisa", "id_cenario", "nm_instituto", "nm_instituto_origem", "dt_inicio_campo",
    "dt_fim_campo", "periodo_texto", "qt_amostra", "pc_margem_erro", "tp_resposta",
    "nm_candidato", "nm_candidato_origem", "sg_partido", "fl_candidato_revisar",
    "pc_intencao_voto", "_ingerido_em",
)
# --------------------------------------------------------------------------------------------


def stage_cells(raw: DataFrame) -> DataFrame:
    """Typed cells with field dates; event rows, artefacts and out-of-range values removed."""
    institute, period = F.col("instituto_texto"), F.col("periodo_texto")
    wanted = raw.filter(
        (F.trim(institute) != "") & (F.trim(period) != "") & (F.trim(institute) != F.trim(period))
    )
    # A filter stands right behind the column it looks at, so dropped rows are typed no further.
    valued = with_settled(wanted.select(*RAW_COLUMNS), {
        "tabela": F.col("tabela_idx").cast("int"),
        "pc_valor": first_number(F.col("valor_texto"), "decimal(9,2)"),
    }).filter(F.col("pc_valor").between(*SHARE_BOUNDS))
    named = with_settled(valued, {"coluna": strip_markup(F.col("coluna_candidato"))})
    answered = with_settled(named, {"tp_resposta": classify_answer(F.col("coluna"))}).filter(
        F.col("tp_resposta") != ARTEFACT
    )
    dated = with_settled(answered, {"periodo": strip_markup(period)})
    kept = with_settled(dated, {
        "__days": period_days(F.col("periodo")), "__months": period_months(F.col("periodo")),
    }).filter((F.size("__days") > 0) & (F.size("__months") > 0))
    loaded = F.to_date("_ingerido_em")

    def boundary(position: int):
        plain = period_boundary(F.col("__days"), F.col("__months"), position, loaded)
        return roll_back_future(plain, loaded)

    return kept.select(
        F.col("tabela").alias("tabela_idx"), strip_markup(institute).alias("nm_instituto_origem"),
        F.col("periodo").alias("periodo_texto"),
        boundary(1).alias("dt_inicio_campo"), boundary(-1).alias("dt_fim_campo"),
        digits_only(strip_markup(F.col("amostra_texto")), "int").alias("qt_amostra"),
        first_number(strip_markup(F.col("margem_texto")), "decimal(5,2)").alias("pc_margem_erro"),
        F.col("coluna").alias("coluna_candidato"), "tp_resposta", "pc_valor", "_ingerido_em",
    )


def standardise(
    cells: DataFrame, institute_map: DataFrame, candidate_map: DataFrame
) -> DataFrame:
    """Standard institute and candidate names, and keys that survive edits of the page.

    The typed cells are read for spellings and for rows, so they are stored first.
    """
    cells = durable(cells, "cells")
    # The lookup meets the distinct spellings, so rows are joined once and need no key.
    spellings = lookup_by_name_key(
        canonical_spellings(cells, "nm_instituto_origem"), "spelling", institute_map,
        "nm_instituto_origem", "nm_instituto_padronizado", "mapped",
    ).select("spelling", F.coalesce("mapped", "canonical").alias("canonical"))
    named = with_canonical(cells, "nm_instituto_origem", spellings, "nm_instituto")
    is_candidate = F.col("tp_resposta") == CANDIDATE
    name, party = split_trailing_token(F.col("coluna_candidato"))
    split = named.select(
        *cells.columns, "nm_instituto",
        F.when(is_candidate, name).alias("nm_candidato_origem"),
        F.when(is_candidate, party).alias("sg_partido"),
    )
    candidates = candidate_map.filter(F.col("fonte") == CELLS_ORIGIN).select(
        F.col("nm_candidato_origem").alias("map_name"),
        F.col("sg_partido_origem").alias("map_party"),
        F.col("nm_candidato_padronizado").alias("__standard"),
        F.col("revisar").alias("__review"),
    )
    mapped = lookup_join(
        split, candidates, {"nm_candidato_origem": "map_name", "sg_partido": "map_party"}
    )
    keyed = mapped.withColumns({
        "nm_candidato": F.when(
            is_candidate, F.coalesce("__standard", "nm_candidato_origem")
        ).otherwise(F.col("coluna_candidato")),
        "fl_candidato_revisar": F.coalesce(F.col("__review"), is_candidate),
    }).drop("__standard", "__review")
    # Read for the sets and for the rows; the joins before it are worth one write.
    keyed = durable(keyed, "keyed-cells").withColumn("__poll", content_text(
        F.col("nm_instituto"), F.col("dt_inicio_campo"), F.col("dt_fim_campo"),
        F.coalesce("qt_amostra", F.lit(0)),
    ))
    # Rows meet by the texts behind the keys, which repeat and compress; hashes are taken of the rows that stay.
    scenarios = with_member_set(keyed, ["__poll", "tabela_idx"], "nm_candidato", "__members")
    kept = first_per_key(
        scenarios, ["__poll", "__members", "nm_candidato"],
        [F.asc(c) for c in (
            "tabela_idx", "nm_instituto_origem", "periodo_texto", "coluna_candidato", "pc_valor",
            "pc_margem_erro", "_ingerido_em",
        )],
    )
    return kept.withColumn("id_pesquisa", content_key(F.col("__poll"))).withColumn(
        "id_cenario", content_key(F.col("id_pesquisa"), F.col("__members"))
    ).drop("__poll", "__members")


def intention_fact(standardised: DataFrame) -> DataFrame:
    return standardised.withColumnRenamed("pc_valor", "pc_intencao_voto").select(*FACT_COLUMNS)


def scenarios_off_balance(fact: DataFrame) -> DataFrame:
    """Scenarios whose shares do not add up to about 100."""
    groups = ["id_cenario", "nm_instituto", "dt_fim_campo"]
    return group_sum_outside(groups, "pc_intencao_voto", *SCENARIO_SUM_BOUNDS)(fact)

