"""Cumulative official results: wide raw table to one row per instant, round and candidate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.cleaning import (
    digits_only, fraction_to_percent, locale_decimal, multi_format_timestamp,
    title_from_column_name,
)
from tallyloom.operators.joins import attach_group_values, lookup_join
from tallyloom.operators.reshape import columns_with_suffix, unpivot_columns

# --- fixed values ---------------------------------------------------------------------------
SHARE_SUFFIX = "_PE_VOTOS_TOT_ACUMULADO"
NOT_CANDIDATES = ("BRANCO" + SHARE_SUFFIX, "NULO" + SHARE_SUFFIX)
RESULTS_ORIGIN = "tse_2022"
# --------------------------------------------------------------------------------------------


def stage_results(raw: DataFrame) -> DataFrame:
    """Candidates are found by the column suffix, so new or renamed ones need no change here."""
    chosen = columns_with_suffix(raw, SHARE_SUFFIX, NOT_CANDIDATES)
    # What all candidates of a row share is typed once, below the unpivot.
    typed = raw.select(
        multi_format_timestamp(F.col("DT_TOTALIZACAO")).alias("ts_totalizacao"),
        digits_only(F.col("TURNO"), "int").alias("nr_turno"), "_ingerido_em", *[F.col(f"`{name}`") for name in chosen],
    )
    long = unpivot_columns(
        typed, ["ts_totalizacao", "nr_turno", "_ingerido_em"], chosen,
        name="coluna_origem", value="pct_texto", upper_names=True,
    )
    fraction = locale_decimal(F.col("pct_texto"), "decimal(12,8)")
    return (
        long.withColumn("__fraction", fraction).filter(F.col("__fraction").isNotNull())
        .select(
            "ts_totalizacao", F.to_date("ts_totalizacao").alias("dt_totalizacao"), "nr_turno", "coluna_origem",
            title_from_column_name(F.col("coluna_origem"), SHARE_SUFFIX).alias("nm_candidato_origem"),
            fraction_to_percent(F.col("__fraction")).alias("pc_votos_validos_acumulado"),
            "_ingerido_em",
        )
    )


def results_fact(staged: DataFrame, candidate_map: DataFrame) -> DataFrame:
    """Standard names (any case) and a flag on the last instant of each round."""
    names = candidate_map.filter(F.col("fonte") == RESULTS_ORIGIN).select(
        F.lower("nm_candidato_origem").alias("name_key"), "nm_candidato_padronizado"
    )
    keyed = staged.withColumn("__name", F.lower("nm_candidato_origem"))
    named = lookup_join(keyed, names, {"__name": "name_key"})
    flagged = attach_group_values(named, ["nr_turno"], __last=F.max("ts_totalizacao"))
    return flagged.select(
        "ts_totalizacao", "dt_totalizacao", "nr_turno",
        F.coalesce("nm_candidato_padronizado", "nm_candidato_origem").alias("nm_candidato"),
        "nm_candidato_origem", "pc_votos_validos_acumulado",
        (F.col("ts_totalizacao") == F.col("__last")).alias("fl_resultado_final"),
        "_ingerido_em",
    )


def final_results_off_balance(fact: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Rounds whose final shares do not add up to 100 within the tolerance."""
    sums = fact.filter("fl_resultado_final").groupBy("nr_turno").agg(
        F.sum("pc_votos_validos_acumulado").alias("pc_soma")
    )
    return sums.filter(F.abs(F.col("pc_soma") - 100) > tolerance)


