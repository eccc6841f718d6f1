"""Survey exports to scored answers and counts of barriers and facilitators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.nulls import if_else
from carelens.functions.text import nth_part, site_group
from carelens.operators.aggs import with_total_rows
from carelens.operators.reshape import crosstab, melt
from carelens.operators.select import drop_withdrawn, left_lookup, pick_columns, stack


def centred(value: Column, does_not_apply=0) -> Column:
    """Answer centred at the midpoint; 'does not apply' becomes the given value."""
    dna = F.lit(does_not_apply).cast("int")
    return if_else(value == fixed.DOES_NOT_APPLY, dna, value - fixed.LIKERT_MIDPOINT)


def oriented(score: Column, reverse: Column) -> Column:
    """Sign flipped for reversed items."""
    return if_else(reverse, -score, score)


def category(score: Column, cutoff=0) -> Column:
    """barriers / neutral / facilitators, the cut-off being neutral on both sides."""
    return (
        F.when(score < -cutoff, "barriers")
        .when(score > cutoff, "facilitators")
        .when(score.isNull(), None)
        .otherwise("neutral")
    )


def raw_value(value: Column) -> Column:
    """Answer on the 1-7 scale as given; 'does not apply' is null."""
    return F.nullif(value, F.lit(fixed.DOES_NOT_APPLY))


def weight(scored: DataFrame) -> Column:
    """How many answers a row of scored answers stands for."""
    return F.col("answers") if "answers" in scored.columns else F.lit(1)


def score_answers(wide: DataFrame, ids: list[str], does_not_apply=0, cutoff=0, counted=False) -> DataFrame:
    """Wide answers to long scored answers.

    ``counted`` first counts equal answers by (ids, item), in the column
    ``answers``: dictionary and scores then meet a few rows per id instead of
    every answer.  Tables and summaries read both forms.

    Two scores exist side by side: ``raw_value`` is the answer as given,
    ``oriented_value`` has reversed items turned; both are null for
    'does not apply', which the category treats as ``does_not_apply``.
    """
    items = pick_columns(wide, prefix="cdi_")
    long = melt(wide.select(*ids, *items), ids, items, "item", "value", drop_null=True)
    if counted:
        long = long.groupBy(*ids, "item", "value").agg(F.count(F.lit(1)).alias("answers"))
    dictionary = fixed.scoring_dictionary(wide.sparkSession).withColumns(
        {"_key": F.col("item"), "level": nth_part(F.col("item"), 2), "_sign": F.when(F.col("isReverse"), -1).otherwise(1)}
    )
    known = left_lookup(long, F.broadcast(dictionary.drop("item")), [("item", "_key")])  # 42 rows
    value = F.col("value")
    scored = known.withColumn("scaled_value", centred(value, does_not_apply) * F.col("_sign")).drop("_sign")
    applies = value != fixed.DOES_NOT_APPLY
    return scored.withColumns(
        {
            "cat": category(F.col("scaled_value"), cutoff),
            "raw_value": raw_value(value),
            "oriented_value": F.when(applies, F.col("scaled_value") + fixed.LIKERT_MIDPOINT),
        }
    )


def count_answers(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by category per key and subscale, with a total row per key."""
    counts = crosstab(scored.filter(F.col("cat").isNotNull()), [*keys, "subscale"], "cat", fixed.CATEGORIES)
    return with_total_rows(counts, keys, "subscale", fixed.CATEGORIES, fixed.TOTAL_SUBSCALE)


def count_wide_answers(wide: DataFrame, keys: list[str], does_not_apply=0, cutoff=0) -> DataFrame:
    """The counts of `count_answers`, taken from the wide rows.

    Each answer column adds to the counts of its subscale inside one
    aggregate, so rows are never multiplied by the number of items: only the
    sums by key go through the shuffle, and those are made long afterwards.
    """
    items = [(i, s, r) for _, i, s, r in fixed.SURVEY_ITEMS if i in wide.columns]
    # scores first, so that each is computed once and not inside every count
    scores = wide.select(
        *keys, *[oriented(centred(F.col(i), does_not_apply), F.lit(r)).alias(i) for i, _, r in items]
    )

    def counted(subscale, test):
        hits = [F.when(test(F.col(i)), 1).otherwise(0) for i, s, _ in items if s == subscale]
        return F.sum(reduce(lambda a, b: a + b, hits))

    tests = {
        "barriers": lambda c: c < -cutoff,
        "neutral": lambda c: c.between(-cutoff, cutoff),
        "facilitators": lambda c: c > cutoff,
    }

    def summed(name):
        return F.aggregate("_rows", F.lit(0).cast("bigint"), lambda acc, r: acc + r[name])

    rows = [
        F.struct(F.lit(s).alias("subscale"), *[counted(s, tests[c]).alias(c) for c in fixed.CATEGORIES])
        for s in sorted({s for _, s, _ in items})
    ]
    sums = scores.groupBy(*keys).agg(F.array(*rows).alias("_rows"))
    total = F.struct(
        F.lit(fixed.TOTAL_SUBSCALE).alias("subscale"),
        *[summed(c).alias(c) for c in fixed.CATEGORIES],
    )
    long = sums.select(*keys, F.explode(F.concat("_rows", F.array(total))).alias("_r")).select(*keys, "_r.*")
    # a subscale nobody answered has no row
    return long.filter(reduce(lambda a, b: a + b, [F.col(c) for c in fixed.CATEGORIES]) > 0)


def survey_scoring(wide: DataFrame, does_not_apply=0, cutoff=0) -> DataFrame:
    """Stacked survey exports to counts by month, site, type and subscale."""
    return count_wide_answers(drop_withdrawn(wide), ["date", "program_id", "type"], does_not_apply, cutoff)


def collapse_sites(scored: DataFrame, sites: list[str], site: str, group: str, kind="PC", value="raw_value") -> DataFrame:
    """Replace the listed sites by one, its answers being their means by item and date."""
    cols = ["item", "q_num", "subscale", "date", "program_id", "type", "site_group", value]
    listed = F.col("program_id").isin(sites)
    merged = (
        scored.filter(listed)
        .groupBy("item", "q_num", "subscale", "date")
        .agg(F.avg(value).alias(value))
        .withColumns({"program_id": F.lit(site), "type": F.lit(kind), "site_group": F.lit(group)})
    )
    rest = scored.filter(~listed).withColumn(value, F.col(value).cast("double"))
    return stack(rest.select(*cols), merged.select(*cols))


def with_site_group(scored: DataFrame, name: str = "PC_group1") -> DataFrame:
    return scored.withColumn("site_group", site_group(F.col("program_id"), fixed.COLLAPSED_SITES, name))
