"""Stored text blocks read back into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.lines import SEPARATOR, line_field

# --- fixed values: fields per line of each block -------------------------------------------
BLOCK_FIELDS = {
    "painel_1t_pesquisas": 10,
    "painel_1t_valores": 5,
    "painel_2t_duelos": 15,
    "painel_institutos": 9,
    "painel_institutos_mes": 4,
}
# -------------------------------------------------------------------------------------------


def read_block(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines of a stored block."""
    return spark.read.text(path).select(F.col("value").alias("linha")).filter(F.col("linha") != "")


def parse_lines(block: DataFrame, fields: Sequence[str], line: str = "linha") -> DataFrame:
    """Fixed positions to named columns; a short line gives NULLs at its end."""
    return block.select(
        *[line_field(F.col(line), i).alias(name) for i, name in enumerate(fields)]
    )


def _field_count(line: str) -> F.Column:
    return F.size(F.split(F.col(line), SEPARATOR, -1))


def wrong_lines(block: DataFrame, count: int, line: str = "linha") -> DataFrame:
    """``line, fields, expected``: the lines that hold another number of fields."""
    fields = _field_count(line)
    return block.filter(fields != count).select(line, fields.alias("fields"), F.lit(count).alias("expected"))


def parse_block(block: DataFrame, name: str, fields: Sequence[str], line: str = "linha") -> DataFrame:
    """A declared block's lines as named columns; a line with another number of fields fails the read.

    ``fields`` names all of them, as many as ``BLOCK_FIELDS`` declares.
    """
    if len(fields) != BLOCK_FIELDS[name]:
        raise ValueError(f"{name} has {BLOCK_FIELDS[name]} fields, not {len(fields)}")
    wrong = F.raise_error(F.concat(F.lit(f"a line of {name} does not have {len(fields)} fields: "), F.col(line)))
    checked = F.when(_field_count(line) == len(fields), F.col(line)).otherwise(wrong)
    return parse_lines(block.select(checked.alias(line)), fields, line)
