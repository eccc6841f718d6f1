"""Grouped summaries.  All of them combine on the map side before the shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.nulls import percent
from carelens.operators.ordered import find_hot, over_ordered, running_sum
from carelens.operators.reshape import pivot_glue
from carelens.operators.select import small_side
from carelens.operators.selection import ranked_summary, sample_sd
from carelens.sources.staging import stage


def _join_groups(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of two grouped tables, missing keys matching missing keys."""
    if not keys:
        row = b.select(F.struct(*b.columns)).scalar()
        return a.withColumn("_t", row).select(*a.columns, *[F.col(f"_t.{c}").alias(c) for c in b.columns])
    b = b.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys])
    return a.join(b, cond, "left").drop(*[f"_k_{k}" for k in keys])


def _value_counts(df: DataFrame, keys: list[str], col: str, weight: str | None) -> tuple[DataFrame, list[str]]:
    """How often each value, and none, occurs per group; kept as a table so the input is read once."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    valued, group = df.withColumn("_v", F.col(col).cast("double")), list(keys)
    if not group:
        valued, group = valued.withColumn("_all", F.lit(1)), ["_all"]
    return stage(valued.groupBy(*group, "_v").agg(n.alias("_n")), "value_counts"), group


# Ranks of approximate quantiles are off by one in ACCURACY rows at most; brackets leave four times that, which in a group
# of more than ACCURACY rows is the two ranks next to the wanted place as well.  Smaller groups keep all their values.
ACCURACY = 10_000
MARGIN = 4 / ACCURACY


def _near_counts(df: DataFrame, keys: list[str], col: str, probs: list[float]) -> tuple[DataFrame, list[str]]:
    """Value counts near the wanted ranks; rows elsewhere are counted as the largest of their stretch, ``_single`` if it is the only one."""
    group = list(keys) or ["_all"]
    valued = df.withColumn("_v", F.col(col).cast("double")).filter("_v is not null")
    valued = (valued if keys else valued.withColumn("_all", F.lit(1))).select(*group, "_v")
    ends = [e for p in probs for e in (max(0.0, p - MARGIN), min(1.0, p + MARGIN))]
    cuts = stage(valued.groupBy(*group).agg(F.percentile_approx("_v", ends, ACCURACY).alias("_cuts"), F.count(F.lit(1)).alias("_rows")), "cuts")
    placed = _join_groups(valued, small_side(cuts), group)
    v, cut = F.col("_v"), lambda i: F.get("_cuts", F.lit(i))
    # a bracket at the very end is open: the approximation may stop short of the smallest or largest value
    above = [F.lit(True) if ends[2 * i] <= 0 else v >= cut(2 * i) for i in range(len(probs))]
    below = [F.lit(True) if ends[2 * i + 1] >= 1 else v <= cut(2 * i + 1) for i in range(len(probs))]
    inside = reduce(lambda a, b: a | b, [a & b for a, b in zip(above, below)], F.col("_rows") <= ACCURACY)
    passed = reduce(lambda a, b: a + b, [(~b).cast("int") for b in below])
    counts = placed.groupBy(*group, passed.alias("_passed"), F.when(inside, v).alias("_own")).agg(
        F.max("_v").alias("_v"), F.count(F.lit(1)).alias("_n"), (F.min("_v") == F.max("_v")).alias("_single")
    )
    return stage(counts.drop("_passed", "_own"), "near_counts"), group


def _from_counts(counts: DataFrame, group: list[str], probs: dict[str, float]) -> DataFrame:
    """Moments and quantiles by group of a value-count table, nulls ignored.

    A running count over the distinct values shows which value holds each
    wanted rank.  No group is gathered in one place: groups with many
    distinct values are cut by value.
    """
    counts = counts.filter("_v is not null")
    totals = counts.groupBy(*group).agg(
        F.sum("_n").alias("_total"), (F.sum(F.col("_n") * F.col("_v")) / F.sum("_n")).alias("_mean")
    )
    hot = find_hot(counts, group, ["_v"])
    ranked = over_ordered(counts, group, ["_v"], {"_upto": running_sum(F.col("_n"))}, hot)
    ranked = _join_groups(ranked, totals, group)

    def value_at(rank):
        value = F.col("_v")
        if "_single" in counts.columns:  # the rank must lie in its bracket, or at least among equal values
            value = F.when(F.col("_single"), value).otherwise(F.raise_error(F.lit("a wanted rank is not in its bracket")).cast("double"))
        return F.max(F.when((F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto")), value))

    away = F.col("_v") - F.col("_mean")
    aggs = {
        "_total": F.max("_total"), "mean": F.max("_mean"), "min": F.min("_v"), "max": F.max("_v"),
        "_ss": F.sum(F.col("_n") * away * away),
    }
    for name, p in probs.items():
        spot = (F.col("_total") - 1) * F.lit(float(p))
        aggs[f"_lo_{name}"] = value_at(F.floor(spot))
        aggs[f"_hi_{name}"] = value_at(F.ceil(spot))
        aggs[f"_w_{name}"] = F.max(spot - F.floor(spot))
    out = ranked.groupBy(*group).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.withColumns(
        {
            "sd": F.when(F.col("_total") > 1, F.sqrt(F.col("_ss") / (F.col("_total") - 1))),
            **{
                n: F.col(f"_lo_{n}") + F.col(f"_w_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))
                for n in probs
            },
        }
    )


def summary_from_counts(counts, keys: list[str], value: str, n: str, probs: dict[str, float]) -> DataFrame:
    """mean, sd, min, max and quantiles of a table that says how often each value occurs."""
    known = counts.select(*keys, F.col(value).cast("double").alias("_v"), F.col(n).alias("_n"))
    return _from_counts(known, list(keys), probs)


def quantiles_by(df: DataFrame, keys: list[str], col: str, probs: dict[str, float], weight: str | None = None) -> DataFrame:
    """Exact quantiles by group with linear interpolation, nulls ignored.

    Rows are read twice and not shuffled: approximate quantiles, whose error
    is known, give a bracket round each wanted rank; then rows outside the
    brackets are counted by where they lie, and values inside kept with
    their counts.  Weighted rows are counts already.
    """
    if weight is None:
        counts, group = _near_counts(df, keys, col, list(probs.values()))
    else:
        counts, group = _value_counts(df, keys, col, weight)
    return _from_counts(counts, group, probs).select(*keys, *probs)


def describe_by(df: DataFrame, keys: list[str], col: str, prefix: str = "", weight: str | None = None) -> DataFrame:
    """mean, sd, median, min and max by group, nulls ignored.

    ``weight`` names a column saying how many rows each row stands for; such
    rows are counts already.  Others are counted in histograms that are
    refined (`selection`), so no table of values is shuffled.  Groups without
    any value keep a row of nulls.
    """
    if weight is None:
        valued = df.select(*keys, F.col(col).cast("double").alias("_v"))
        group = list(keys) or ["_all"]
        stats = ranked_summary(valued if keys else valued.withColumn("_all", F.lit(1)), group, {"median": 0.5}).withColumn("sd", sample_sd())
        stats = stats if keys else stats.filter("_total > 0")
        return stats.select(*keys, *[F.col(s).alias(f"{prefix}{s}") for s in ("mean", "sd", "median", "min", "max")])
    counts, group = _value_counts(df, keys, col, weight)
    stats = _from_counts(counts, group, {"median": 0.5})
    stats = stats.select(*keys, *[F.col(s).alias(f"{prefix}{s}") for s in ("mean", "sd", "median", "min", "max")])
    return _join_groups(counts.select(*keys).distinct(), stats, keys) if keys else stats


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: min, quartiles, mean, max and number of nulls."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    stats = ranked_summary(long.withColumnRenamed("value", "_v"), ["column"], {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return stats.select("column", "min", "q1", "median", "mean", "q3", "max", F.col("_missing").alias("n_null"))


def mean_by(df, keys, col, out="mean") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(col).alias(out))


def mean_all(df, keys, cols, fn=F.avg, suffix="") -> DataFrame:
    """The same summary of every listed column."""
    return df.groupBy(*keys).agg(*[fn(F.col(c).cast("double")).alias(f"{c}{suffix}") for c in cols])


def with_total_rows(df, keys: list[str], over: str, sums: list[str], label: str) -> DataFrame:
    """Append one row per key that adds up all values of ``over``.

    ``df`` has one row per (keys, over); it is read once, each row counting
    for itself and for the total.
    """
    both = df.withColumn(over, F.explode(F.array(F.col(over), F.lit(label))))
    return both.groupBy(*keys, over).agg(*[F.sum(c).alias(c) for c in sums])


def means_by_type_and_all(df, group: list[str], value: str, types: list[str], out="mean_v", kind="type") -> DataFrame:
    """Mean by (group, type) beside the mean of the group over all types, from one scan."""
    return df.groupBy(*group).agg(
        *[F.avg(F.when(F.col(kind) == t, F.col(value))).alias(f"{t}_{out}") for t in types],
        F.avg(value).alias(f"all_{out}"),
    )


def share(df, keys: list[str], col: str, out="share") -> DataFrame:
    """Share of the group total.

    The total is a grouped sum joined back rather than a window, so a large
    group is never gathered in one task.
    """
    totals = stage(df.groupBy(*keys).agg(F.sum(col).alias("_total")), "totals")
    return _join_groups(df, small_side(totals), keys).withColumn(out, F.try_divide(F.col(col), F.col("_total"))).drop("_total")


def group_any(df, keys: list[str], cond, out: str) -> DataFrame:
    """Whether any row of the group meets a condition."""
    flags = df.groupBy(*keys).agg(F.coalesce(F.bool_or(cond), F.lit(False)).alias(out))
    return _join_groups(df, small_side(stage(flags, "flags")), keys)


def latest_per_key(df, keys: list[str], date: str) -> DataFrame:
    """Rows at the latest date of their key, ties kept."""
    newest = df.groupBy(*keys).agg(F.max(date).alias("_newest"))
    return _join_groups(df, small_side(stage(newest, "newest")), keys).filter(F.col(date) == F.col("_newest")).drop("_newest")


def latest(df, date: str) -> DataFrame:
    """Rows at the latest date of the table; the date comes from a scalar subquery."""
    return df.filter(F.col(date) == df.agg(F.max(date)).scalar())


def entity_counts(df, entity: str, kind: str, types: list[str]) -> DataFrame:
    """Number of entities in total and per type, one row.

    Entities are reduced to one row with type flags first; several distinct
    counts in one aggregate would multiply the input rows.
    """
    seen = df.groupBy(entity).agg(*[F.bool_or(F.col(kind) == t).alias(f"_{t}") for t in types])
    return seen.agg(*[F.count_if(F.col(f"_{t}")).alias(f"{t}_n") for t in types], F.count(F.lit(1)).alias("all_n"))


def count_and_pct(counts, base, keys: list[str], count: str, base_value: str, names: tuple[str, str]) -> DataFrame:
    """A count and its percent of a base measure, both as long rows."""
    joined = _join_groups(counts, base.select(*keys, F.col(base_value).alias("_base")), keys)
    n = F.col(count).cast("double")
    wide = joined.select(*keys, n.alias(names[0]), percent(n, F.col("_base")).alias(names[1]))
    return wide.unpivot(keys, list(names), "variable", "value")


def type_summary(df, keys: list[str], kind: str, col: str, types: list[str], weight: str | None = None) -> DataFrame:
    """Five statistics per type, side by side."""
    stats = ["mean", "sd", "median", "min", "max"]
    return pivot_glue(describe_by(df, [*keys, kind], col, weight=weight), keys, kind, stats, types)


