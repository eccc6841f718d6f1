"""Survey summaries, tests, regression inputs and site selections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.nulls import recode, weighted_mean
from carelens.operators.aggs import describe_by, type_summary
from carelens.operators.joins import natural_left
from carelens.operators.reshape import pivot
from carelens.operators.select import left_lookup, same_keys, small_side, stack
from carelens.operators.stats import linear_grid, random_intercept_by, spearman_by
from carelens.operators.windows import zscore
from carelens.plans.survey import weight
from carelens.sources.staging import cut_lineage

SITE = ["program_id", "type", "site_group"]


def _mean(scored: DataFrame, value: str):
    return weighted_mean(F.col(value), weight(scored))


def site_subscale_means(scored: DataFrame, value="raw_value") -> DataFrame:
    return scored.groupBy(*SITE, "subscale").agg(_mean(scored, value).alias("subscale_val"))


def site_total_means(scored: DataFrame, value="raw_value") -> DataFrame:
    return scored.groupBy(*SITE).agg(_mean(scored, value).alias("total_val"))


def site_distribution(scored: DataFrame) -> DataFrame:
    """Site means by subscale and in total, subscales without a mean left out."""
    total = site_total_means(scored).withColumn("subscale", F.lit("total")).withColumnRenamed("total_val", "subscale_val")
    return stack(site_subscale_means(scored).na.drop(subset=["subscale_val"]), total)


def _summary(rows: DataFrame, key: str, value: str, digits: int | None) -> DataFrame:
    """Statistics and test from counts of equal answers, which are kept: the rows are read once."""
    counts = cut_lineage(rows.groupBy(key, "type", "site_group", value).agg(F.sum(weight(rows)).alias("_answers")))
    total = describe_by(counts, [key], value, "total_", "_answers")
    by_type = type_summary(counts, [key], "type", value, ["PC", "SUD"], "_answers")
    coded = counts.withColumn("_is_sud", F.when(F.col("type") == "SUD", 1.0).when(F.col("type") == "PC", 0.0))
    p = random_intercept_by(coded, [key], value, "_is_sud", "site_group", "_answers").select(
        key, F.bround("p_val", digits).alias("p_val") if digits else F.col("p_val")
    )
    return natural_left(natural_left(total, by_type), p)


def question_summary(scored: DataFrame) -> DataFrame:
    """Per question: five statistics in total and by site type, p-value of the type."""
    return _summary(scored, "q_num", "raw_value", None)


def subscale_summary(scored: DataFrame) -> DataFrame:
    """The same per subscale, on site means."""
    return _summary(site_subscale_means(scored), "subscale", "subscale_val", 4)


def subscale_vs_reach(scored: DataFrame, measures: DataFrame, date: str, variable: str = "reaim_b4p") -> DataFrame:
    """Spearman correlation of each subscale, and the total, with one measure of one month."""
    total = site_total_means(scored).withColumn("subscale", F.lit("total")).withColumnRenamed("total_val", "subscale_val")
    reach = measures.filter((F.col("date") == F.lit(date).cast("date")) & (F.col("variable") == variable))
    reach = reach.select("program_id", "type", F.col("value").alias("reaim_val"))
    return spearman_by(
        natural_left(stack(site_subscale_means(scored), total), reach), ["subscale"], "subscale_val", "reaim_val"
    )


def total_vs_imat(scored: DataFrame, imat: DataFrame, variable: str = "imat_total") -> DataFrame:
    """Spearman correlation of the total score with the integration total."""
    picked = imat.filter(F.col("variable") == variable).select("program_id", F.col("value").alias("imat_val"))
    return spearman_by(natural_left(site_total_means(scored), picked), [], "total_val", "imat_val")


def community_factors(
    scored: DataFrame, items: DataFrame, info: DataFrame, date: str | None = None, questions=fixed.FACTOR_QUESTIONS,
    item=fixed.FACTOR_ITEM, excluded=fixed.FACTOR_EXCLUDED_SITES,
) -> DataFrame:
    """Question values and one integration item by site and date, site attributes, exclusions.

    ``date`` is the survey date; without it each date of a site is a row.  The
    1-5 item is put on the 1-7 scale.  Several answers of a site on a date are
    averaged, so that a cell is unique.
    """
    keys = ["program_id", "date"]
    if date is not None:
        day = F.lit(date).cast("date")
        scored, items = scored.filter(F.col("date") == day), items.filter(F.col("date") == day)
    asked = scored.filter(F.col("q_num").isin(questions)).groupBy(*keys, "q_num").agg(_mean(scored, "raw_value").alias("mean"))
    wide = pivot(asked, keys, "q_num", "mean", questions, prefix="cdi_")
    scaled = items.filter(F.col("variable") == item).withColumn(item, recode(F.col("value"), fixed.FIVE_TO_SEVEN).cast("double"))
    picked = scaled.groupBy(*keys).agg(F.avg(item).alias(item))
    joined = same_keys(wide, picked, keys)
    return left_lookup(joined, small_side(info), [("program_id", "program_id")]).filter(
        ~F.col("program_id").isin(excluded)
    )


def factor_columns(questions=fixed.FACTOR_QUESTIONS, item=fixed.FACTOR_ITEM) -> list[str]:
    return [*[f"cdi_{q}" for q in questions], item]


def factor_summary(study: DataFrame) -> DataFrame:
    """Means and sds of the factors."""
    c = {name: F.col(name).cast("double") for name in factor_columns()}
    return study.agg(
        *[F.avg(v).alias(f"{n}_mean") for n, v in c.items()], *[F.stddev_samp(v).alias(f"{n}_sd") for n, v in c.items()]
    )


def site_category_shares(scored: DataFrame) -> DataFrame:
    """Percent of each category by site, two digits."""
    counts = scored.groupBy("program_id").agg(
        *[F.sum(F.when(F.col("cat") == c, weight(scored)).otherwise(0)).alias(c) for c in fixed.CATEGORIES]
    )
    total = sum((F.col(c) for c in fixed.CATEGORIES[1:]), F.col(fixed.CATEGORIES[0]))
    return counts.select(
        "program_id", *[F.bround(F.try_divide(F.col(c), total) * 100, 2).alias(c) for c in fixed.CATEGORIES]
    )


def regression_inputs(scored: DataFrame, measures: DataFrame, date: str) -> DataFrame:
    """Site mean score, percent of each category, and the outcomes of one month."""
    mean = scored.groupBy("program_id").agg(_mean(scored, "raw_value").alias("mean_likert"))
    picked = measures.filter(
        (F.col("date") == F.lit(date).cast("date")) & F.col("variable").isin("reaim_b4", "reaim_b4p")
    )
    outcomes = pivot(picked, ["program_id"], "variable", "value", ["reaim_b4", "reaim_b4p"]).withColumnsRenamed(
        {"reaim_b4": "count_MOUD", "reaim_b4p": "pct_MOUD"}
    )
    return same_keys(same_keys(mean, site_category_shares(scored), ["program_id"]), outcomes, ["program_id"])


def regression_grid(inputs: DataFrame) -> DataFrame:
    return linear_grid(inputs, ["count_MOUD", "pct_MOUD"], ["mean_likert", "barriers", "facilitators"])


def site_features(scored: DataFrame, feature: str, names: list[str], distinct: bool) -> DataFrame:
    """Site by feature means, standardised; of sites with equal features the lowest id stays."""
    means = scored.groupBy("program_id", feature).agg(_mean(scored, "raw_value").alias("mean_likert"))
    wide = cut_lineage(pivot(means, ["program_id"], feature, "mean_likert", names))  # one row per site
    scaled = zscore(wide, names)
    if not distinct:
        return scaled
    return scaled.groupBy(*names).agg(F.min("program_id").alias("program_id")).select("program_id", *names)


def interview_table(info: DataFrame, measures: DataFrame, scored: DataFrame) -> DataFrame:
    """One row per site: attributes, latest of six measures, mean of the system-level questions."""
    system = (
        scored.filter(F.col("item").contains("outer"))
        .groupBy("program_id")
        .agg(_mean(scored, "raw_value").alias("mean_system_CDI"))
    )
    picked = measures.filter(F.col("variable").isin(fixed.INTERVIEW_VARIABLES))
    newest = picked.groupBy("program_id", "variable").agg(F.max_by(F.struct("value"), "date")["value"].alias("value"))
    wide = pivot(newest, ["program_id"], "variable", "value", fixed.INTERVIEW_VARIABLES)
    return same_keys(same_keys(info, wide, ["program_id"]), system, ["program_id"], "full")


