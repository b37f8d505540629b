"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.periods import calendar_columns
from tallyloom.operators.reshape import date_series

# --- fixed values: round dates per election cycle --------------------------------------------
CYCLES = {
    "2022": ("2022-10-02", "2022-10-30"),
    "2026": ("2026-10-04", "2026-10-25"),
}
LAST_YEAR_OF_FIRST_CYCLE = 2022
FIRST_DAY, LAST_DAY = "2022-01-01", "2026-12-31"
# ---------------------------------------------------------------------------------------------


def calendar_bounds(spark, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    return spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )


def calendar_dimension(
    bounds: DataFrame, cycles: dict[str, tuple[str, str]] = CYCLES,
    last_year_of_first_cycle: int = LAST_YEAR_OF_FIRST_CYCLE,
) -> DataFrame:
    """One row per day between the bounds (``first``, ``last``)."""
    days = date_series(bounds, "first", "last", "dt")
    return days.select(*calendar_columns(F.col("dt"), last_year_of_first_cycle, cycles))
