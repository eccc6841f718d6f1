"""Baseline exports and site attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.dates import month_from_event, parse_date
from carelens.functions.nulls import null_sum, pct_clamped, recode, tokens_to_null, try_number
from carelens.functions.text import contains_any
from carelens.operators.reshape import melt, melt_regex, melt_split, pivot
from carelens.operators.select import drop_withdrawn, pick_columns, rename_map, stack_tagged

PREFIX = "demo_moud_"


def baseline_reaim(export: DataFrame) -> DataFrame:
    """Baseline counts to the long measure table.

    The export has b1 and b2 the wrong way round; b4 takes in b3, and b4p is
    its percent of b1.  Variables come from the column names, so nothing is
    collected to learn them.
    """
    cols = pick_columns(export, prefix=PREFIX)
    variables = sorted({c.removeprefix(PREFIX).split("_")[0] for c in cols})
    clean = export.withColumns({c: tokens_to_null(F.col(c), fixed.NULL_TOKENS) for c in cols})
    long = melt_split(
        drop_withdrawn(clean), ["program_id", "type"], cols, PREFIX, "_", ["variable", "month"]
    )
    wide = pivot(long, ["program_id", "type", "month"], "variable", "value", variables)
    wide = rename_map(wide, {"b1": "b2", "b2": "b1"})
    b4 = null_sum(F.col("b4"), F.col("b3"))
    wide = wide.withColumn("b4", b4).withColumn("b4p", pct_clamped(F.col("b4"), F.col("b1")))
    kept = sorted({*variables, "b4p"})
    out = melt(wide, ["program_id", "type", "month"], [c for c in kept if c[0] in "ab"])
    return out.select(
        parse_date(F.col("month"), ["MMMyyyy"]).alias("date"),
        "program_id",
        F.concat(F.lit("reaim_"), F.col("variable")).alias("variable"),
        "value",
        "type",
    )


def baseline_imat(export: DataFrame, event: str = "sep_2022_arm_1") -> DataFrame:
    """Integration means of one survey event to the long measure table."""
    rows = drop_withdrawn(export).filter(F.col("event_name") == event)
    ids = ["program_id", "type", "event_name"]
    means = pick_columns(rows, suffix="_mean")
    text = rows.select(*ids, *[F.col(c).cast("string").alias(c) for c in means])
    long = melt_regex(text, ids, r"(.*)_mean").filter(F.col("value").isNotNull())
    return long.select(
        month_from_event(F.col("event_name")).alias("date"), "program_id", "variable",
        try_number(F.col("value")).alias("value"), "type",
    )


def care_level(outpatient: Column, inpatient: Column) -> Column:
    return F.when(outpatient & inpatient, "Both").when(outpatient, "Outpatient").when(inpatient, "Inpatient")


def program_info(sud: DataFrame, pc: DataFrame) -> DataFrame:
    """Goal, site type and care level by site; primary care is always outpatient."""
    level = F.coalesce(F.col("demo_level_of_care").cast("string"), F.lit(""))
    sud_level = care_level(contains_any(level, ["1", "2"]), contains_any(level, ["3", "4", "5"]))
    parts = {
        "SUD": drop_withdrawn(sud).withColumn("care_level", sud_level),
        "PC": drop_withdrawn(pc).withColumn("care_level", care_level(F.lit(True), F.lit(False))),
    }
    stacked = stack_tagged(parts, "site_type")
    return stacked.select(
        "program_id", recode(F.col("demo_goal"), fixed.GOAL_LABELS).alias("demo_goal"), "site_type", "care_level"
    )
