"""Series behind the site reports, for all sites at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.dates import month_label
from carelens.functions.nulls import pct_zero_default
from carelens.functions.text import list_position
from carelens.operators.reshape import pivot
from carelens.operators.select import label

OLDER = {"denom": "reaim_b1", "numer": "reaim_b4", "percent": "reaim_b4p"}
NEWER = {"denom": "reaim_b2", "numer": "reaim_b5", "percent": "reaim_b5p"}


def report_moud(long: DataFrame) -> DataFrame:
    """Numerator, denominator and percent by site and month.

    A site that reports b5p uses the newer measures.  The position of the
    target label depends on the percent of the site's latest month.

    The long table is read once, into one row per site and month; what a site
    needs from its other months is then a window over those few rows.
    """
    v, names = F.col("variable"), [*OLDER.values(), *NEWER.values()]
    wide = long.filter(v.isin(names)).groupBy("program_id", "date").agg(
        *[F.max(F.when(v == n, F.col("value"))).alias(n) for n in names],
        F.bool_or(v == NEWER["percent"]).alias("_says_newer"),
        F.bool_or(v.isin(list(OLDER.values()))).alias("_older"),
        F.bool_or(v.isin(list(NEWER.values()))).alias("_newer"),
    )
    site = Window.partitionBy("program_id")  # months of one site
    newer = F.max("_says_newer").over(site)
    picked = wide.withColumn("_use", newer).filter(F.when(F.col("_use"), F.col("_newer")).otherwise(F.col("_older")))
    picked = picked.select(
        "program_id", "date",
        *[F.when(F.col("_use"), F.col(NEWER[r])).otherwise(F.col(OLDER[r])).alias(r) for r in ("numer", "denom", "percent")],
    )
    last = F.max_by(F.struct("percent"), "date").over(site)["percent"]
    return picked.withColumns({"target_x": F.max("date").over(site), "_last": last}).withColumn(
        "target_y", F.when(F.col("_last") > fixed.TARGET_PERCENT, 65).when(F.col("_last").isNotNull(), 85)
    ).drop("_last")


def report_fast_access(long: DataFrame) -> DataFrame:
    """Percent within 72 hours by site and month, with its 'n/d' label."""
    rows = long.filter(F.col("variable").isin("reaim_c1_n", "reaim_b2"))
    wide = pivot(rows, ["program_id", "date"], "variable", "value", ["reaim_c1_n", "reaim_b2"])
    n, d = F.col("reaim_c1_n"), F.col("reaim_b2")
    parts = [F.coalesce(c.cast("bigint").cast("string"), F.lit("NA")) for c in (n, d)]
    return wide.withColumns({"percent72h": pct_zero_default(n, d), "label": F.concat_ws("/", *parts)})


def report_linkage(long: DataFrame) -> DataFrame:
    """Three referral measures by site and month; the last named is stacked first."""
    rows = long.filter(F.col("variable").isin(fixed.REFERRAL_VARIABLES))
    rows = rows.withColumn("stack_order", list_position(F.col("variable"), fixed.REFERRAL_VARIABLES[::-1]))
    return label(rows, "variable", fixed.REFERRAL_NAMES, "label")


def report_imat(long: DataFrame, program_id: str = "all", dates=fixed.REPORT_DATES) -> DataFrame:
    """Integration values by variable for the report dates: one site, or the mean of all.

    Other dates keep their rows with an empty date label.
    """
    rows = long.filter(F.col("variable").startswith("imat"))
    if program_id == "all":
        rows = rows.groupBy("date", "variable").agg(F.avg("value").alias("value"))
    else:
        rows = rows.filter(F.col("program_id") == program_id).select("date", "variable", "value")
    text = month_label(F.col("date"), "MMM-yy")
    return rows.select(
        "date", "variable", "value", F.when(text.isin(dates), text).alias("date_label"),
        list_position(text, dates).alias("date_order"),
    )
