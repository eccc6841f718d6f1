"""Survey tables: mean scores and shares of barriers and facilitators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.text import list_position
from carelens.operators.joins import beside_totals
from carelens.operators.select import label, same_keys, stack
from carelens.plans.survey import weight
from carelens.sources.staging import cut_lineage

SHARES = ["barriers_percent", "facilitators_percent"]
ORDER = [code for code, _ in fixed.DISPLAY_NAMES]


def answer_cells(scored: DataFrame) -> DataFrame:
    """Answers counted by site, question and category, with the sum of scores.

    All tables are sums over these cells, so the answers are read once; the
    cells are sites by questions by categories, whatever the number of answers.
    """
    w, v = weight(scored), F.col("oriented_value")
    return cut_lineage(
        scored.groupBy("program_id", "type", "subscale", "level", "q_num", "cat").agg(
            F.sum(w).alias("n"), F.sum(v * w).alias("score"), F.sum(F.when(v.isNotNull(), w)).alias("n_score")
        )
    )


def score_means(cells: DataFrame, group: list[str]) -> DataFrame:
    """Mean oriented score by group, for each site type and all sites."""

    def mean(cond=None):
        part = [F.when(cond, F.col(c)) if cond is not None else F.col(c) for c in ("score", "n_score")]
        return F.try_divide(F.sum(part[0]), F.sum(part[1]))

    return cells.groupBy(*group).agg(
        *[mean(F.col("type") == t).alias(f"{t}_mean_v") for t in fixed.SITE_TYPES], mean().alias("all_mean_v")
    )


def site_shares(cells: DataFrame, group: str) -> DataFrame:
    """Share of barriers and facilitators by site and group.

    A cell with neutral answers only is left out rather than shown as 0:
    the published totals depend on it.
    """
    n = F.sum("n")
    bad = F.coalesce(F.sum(F.when(F.col("cat") == "barriers", F.col("n"))), F.lit(0))
    good = F.coalesce(F.sum(F.when(F.col("cat") == "facilitators", F.col("n"))), F.lit(0))
    out = cells.groupBy("program_id", "type", group).agg(
        (bad / n).alias("barriers_percent"), (good / n).alias("facilitators_percent"), (bad + good).alias("_known")
    )
    return out.filter("_known > 0").drop("_known")


def share_means(shares: DataFrame, group: list[str]) -> DataFrame:
    """Unweighted mean of the site shares by group, for each site type and all sites."""
    return shares.groupBy(*group).agg(
        *[F.avg(F.when(F.col("type") == t, F.col(c))).alias(f"{t}_{c}") for t in fixed.SITE_TYPES for c in SHARES],
        *[F.avg(c).alias(f"all_{c}") for c in SHARES],
    )


def total_row(cells: DataFrame) -> DataFrame:
    """Totals of the tables; both tables take their shares from site by level cells."""
    return beside_totals(score_means(cells, []), share_means(site_shares(cells, "level"), []))


def _table(cells: DataFrame, group: str) -> DataFrame:
    body = same_keys(score_means(cells, [group]), share_means(site_shares(cells, group), [group]), [group])
    rows = stack(body, total_row(cells).withColumn(group, F.lit("total")))
    named = label(rows, group, fixed.DISPLAY_NAMES, "fmt_name")
    return named.withColumn("position", list_position(F.col(group), ORDER)).drop(group)


def subscale_table(scored: DataFrame) -> DataFrame:
    return _table(answer_cells(scored), "subscale")


def level_table(scored: DataFrame) -> DataFrame:
    return _table(answer_cells(scored), "level")


def question_table(scored: DataFrame) -> DataFrame:
    """Mean score by question, with a mean row per subscale."""
    cells = answer_cells(scored)
    questions = score_means(cells, ["subscale", "q_num"])
    means = score_means(cells, ["subscale"]).withColumn("q_num", F.lit("Subgroup Mean"))
    rows = label(stack(questions, means), "subscale", fixed.DISPLAY_NAMES, "fmt_name")
    return rows.withColumn("position", list_position(F.col("subscale"), ORDER)).drop("subscale")
