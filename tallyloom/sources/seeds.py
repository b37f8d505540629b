"""Small versioned lookup files with typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INSTITUTE_MAP_SCHEMA = (
    "nm_instituto_origem string, nm_instituto_padronizado string, revisar boolean"
)
CANDIDATE_MAP_SCHEMA = (
    "fonte string, nm_candidato_origem string, sg_partido_origem string, "
    "nm_candidato_padronizado string, revisar boolean"
)
REGISTERED_CANDIDATES_SCHEMA = "nm_candidato string, ds_observacao string"
INSTITUTE_PATTERNS_SCHEMA = "inst_ok string, chave_tse string"


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A comma-separated lookup file; empty fields are NULL, types are never guessed."""
    return spark.read.csv(
        path, schema=schema, header=True, enforceSchema=False, quote='"', escape='"', multiLine=True, mode="FAILFAST"
    )
