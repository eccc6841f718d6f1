"""Stacking of measure sources and manual corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.nulls import try_number
from carelens.functions.text import site_type
from carelens.operators.joins import replace_by_key
from carelens.operators.reshape import melt, pivot
from carelens.operators.select import stack

LONG = ["date", "program_id", "variable", "value", "type"]


def combined_long(*sources: DataFrame) -> DataFrame:
    """One long measure table; the site type follows from the site id."""
    cols = [c for c in LONG if c != "type"]
    rows = stack(*[s.select(*cols) for s in sources])
    return rows.withColumn("type", site_type(F.col("program_id"))).select(*LONG)


def manual_override(baseline: DataFrame, manual: DataFrame) -> DataFrame:
    """Manual rows replace the baseline rows of their sites; integration rows stay."""
    return replace_by_key(baseline.select(*LONG), manual.select(*LONG), "program_id", "imat_")


def c1_correction(
    manual: DataFrame, variables: list[str], rebased=fixed.REBASED_MONTHS, kept=fixed.KEPT_MONTHS
) -> DataFrame:
    """c1 of some months put on the base of the later ones: (c1/100)*b2/b4.

    The result of a rebased month is a fraction, not a percent, as defined.
    """
    ids = ["program_id", "date", "type"]
    numbers = manual.filter(F.col("date").isin([*rebased, *kept])).withColumn("_v", try_number(F.col("final_value")))
    wide = pivot(numbers, ids, "variable", "_v", variables)
    fixed_c1 = F.try_divide(F.col("reaim_c1") / 100 * F.col("reaim_b2"), F.col("reaim_b4"))
    wide = wide.withColumn(
        "reaim_c1", F.when(F.col("date").isin(rebased), fixed_c1).otherwise(F.col("reaim_c1"))
    )
    return melt(wide, ids, variables, "variable", "final_value").select(
        "date", "program_id", "variable", "final_value", "type"
    )
