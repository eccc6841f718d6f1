"""Integration survey: items, dimension means, averages and item summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.dates import month_from_event
from carelens.functions.nulls import row_mean, strict
from carelens.functions.text import flatten_lines, site_type
from carelens.operators.aggs import _join_groups, latest, summary_from_counts
from carelens.operators.reshape import melt, melt_regex, pivot
from carelens.operators.select import filter_any_not_null, label, label_with_counts, pick_columns, stack
from carelens.sources.staging import cut_lineage

IDS = ["program_id", "date"]


def answered(export: DataFrame) -> DataFrame:
    """Item and mean columns without comments, rows with at least one answer."""
    cols = [
        c for c in pick_columns(export, prefix="imat_", drop_suffix="_c")
        if c.startswith("imat_d") or c == "imat_total_mean"
    ]
    dated = export.withColumn("date", month_from_event(F.col("event_name")))
    return filter_any_not_null(dated.select(*IDS, *cols), cols)


def imat_items(export: DataFrame) -> DataFrame:
    rows = answered(export)
    items = [c for c in pick_columns(rows, drop_suffix="_mean") if c not in IDS]
    return melt(rows, IDS, items)


def imat_subscales(export: DataFrame) -> DataFrame:
    """Dimension means and the low-barrier-care subscale, in one pass over the export."""
    rows = answered(export).withColumn("imat_s1_mean", row_mean(fixed.LOW_BARRIER_ITEMS))
    means = pick_columns(rows, suffix="_mean")
    wide = rows.select(*IDS, *[F.col(c).cast("double").alias(c) for c in means])
    return melt_regex(wide, IDS, r"(.*)_mean")


def imat_averages(subscales: DataFrame) -> DataFrame:
    """Mean, highest and lowest value by variable and site type at the latest date."""
    typed = latest(subscales, "date").withColumn("type", site_type(F.col("program_id")))
    v = F.col("value")
    return typed.groupBy("variable", "type").agg(
        strict(F.avg, v).alias("mean_v"), strict(F.max, v).alias("max_v"), strict(F.min, v).alias("min_v")
    )


def imat_averages_table(subscales: DataFrame) -> DataFrame:
    """Averages by dimension name, one column per site type with the number of sites in its header."""
    typed = subscales.withColumn("type", site_type(F.col("program_id")))
    sizes = typed.groupBy("type").agg(F.count_distinct("program_id").alias("n"))
    counts = {r["type"]: r["n"] for r in sizes.collect()}  # two site types
    named = label(imat_averages(subscales), "variable", fixed.DIMENSION_NAMES, "label")
    named = named.withColumns({"Dimension": flatten_lines(F.col("label")), "mean_v": F.bround("mean_v", 2)})
    # the derived subscale has no display name and shows under an empty one
    wide = pivot(named, ["variable", "Dimension"], "type", "mean_v", sorted(counts)).drop("variable")
    return label_with_counts(wide, counts)


def imat_item_summary(subscales: DataFrame, items: DataFrame, date: str) -> DataFrame:
    """Mean, sd and quartiles by variable at one date; null when any value is missing."""
    cols = ["date", "program_id", "variable", "value"]
    rows = stack(
        subscales.select(*cols), items.select("date", "program_id", "variable", F.col("value").cast("double").alias("value"))
    ).filter(F.col("date") == F.lit(date).cast("date"))
    v = F.col("value")
    # answers of one date at few levels: counted first, read once
    rows = cut_lineage(rows.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n")))
    whole = rows.groupBy("variable").agg((F.count(v) == F.count(F.lit(1))).alias("_whole"))
    stats = summary_from_counts(rows, ["variable"], "value", "n", {"ptile25": 0.25, "ptile75": 0.75})
    joined = _join_groups(whole, stats, ["variable"])
    return joined.select(
        "variable", *[F.when(F.col("_whole"), F.col(c)).alias(c) for c in ("mean", "sd", "ptile25", "ptile75")]
    )
