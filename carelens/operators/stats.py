"""Grouped statistics: a distributed reduction, then arithmetic on the reduced rows."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions.tdist import normal_tail, two_sided_p
from carelens.operators.aggs import _join_groups
from carelens.operators.mixed import random_intercept_by  # noqa: F401
from carelens.operators.ordered import Hot, find_hot, over_ordered, running_sum
from carelens.sources.staging import cut_lineage, stage


def _mean_ranks(pairs: DataFrame, keys: list[str], col: str, out: str, hot: Hot | None) -> DataFrame:
    """Average rank of each distinct value by group, from value counts."""
    counts = pairs.groupBy(*keys, col).agg(F.sum("_n").alias("_c"))
    ranked = over_ordered(counts, keys, [col], {"_upto": running_sum(F.col("_c"))}, hot)
    return ranked.select(*keys, col, (F.col("_upto") - (F.col("_c") - 1) / 2).alias(out))


# Limits of the rank test and coefficients of its series (algorithm AS 89): fixed values.
EXACT_RANKS, SERIES_RANKS = 9, 1290
_RANK_SERIES = [0.2274, 0.2531, 0.1745, 0.0758, 0.1033, 0.3932, 0.0879, 0.0151, 0.0072, 0.0831, 0.0131, 4.6e-4]


def rank_distance_counts(n: int) -> list[int]:
    """How many permutations of n ranks have each sum of squared differences, by half the sum."""
    states: dict[int, dict[int, int]] = {0: {0: 1}}
    for i in range(n):
        following: dict[int, dict[int, int]] = {}
        for taken, sums in states.items():
            for j in range(n):
                if not taken >> j & 1:
                    into = following.setdefault(taken | 1 << j, {})
                    for total, times in sums.items():
                        into[total + (i - j) ** 2] = into.get(total + (i - j) ** 2, 0) + times
        states = following
    [sums] = states.values()
    return [sums.get(2 * k, 0) for k in range((n**3 - n) // 6 + 1)]


def _rank_p(n, cor) -> Column:
    """Two-sided p of a rank correlation without ties, as the test for small samples has it.

    Up to 9 pairs all permutations are counted; beyond, an Edgeworth series
    for the sum of squared rank differences.
    """
    n = n.cast("double")  # the cube of two million is no long
    n3 = n * n * n - n
    s = F.round(n3 * (1 - cor) / 6)  # an even whole number
    above = s > n3 / 6
    exact = F.lit(None).cast("double")
    for m in range(2, EXACT_RANKS + 1):
        counts = rank_distance_counts(m)
        at = (s / 2).cast("int")
        inner = F.when(above, F.slice(F.lit(counts), at + 1, len(counts))).otherwise(F.slice(F.lit(counts), 1, at + 1))
        part = F.aggregate(inner, F.lit(0).cast("long"), lambda acc, c: acc + c.cast("long")) / sum(counts)
        exact = F.when(n == m, part).otherwise(exact)
    c, b = _RANK_SERIES, 1 / n
    # the upper tail from s on, or the lower one up to s: the next sum is s + 2
    x = (6 * (F.when(above, s).otherwise(s + 2) - 1) * b / (n * n - 1) - 1) * F.sqrt(1 / b - 1)
    y = x * x
    u = x * b * (
        c[0] + b * (c[1] + c[2] * b)
        + y * (-c[3] + b * (c[4] + c[5] * b) - y * b * (c[6] + c[7] * b - y * (c[8] - c[9] * b + y * b * (c[10] - c[11] * y))))
    ) / F.exp(y / 2)
    series = F.when(above, normal_tail(x) + u).otherwise(normal_tail(-x) - u)
    one = F.when(n <= EXACT_RANKS, exact).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))
    return F.least(2 * one, F.lit(1.0))


def spearman_by(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Spearman correlation and p-value by group over complete pairs.

    Without ties and up to 1290 pairs the p-value comes from the distribution
    of the rank differences (`_rank_p`), else from the t approximation.

    Equal pairs are counted first and the counts kept, and ranks come from
    running counts over distinct values, so a group of any size is spread
    over tasks and the input is read once.
    """
    group = list(keys) or ["_all"]
    base = df.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).na.drop(
        subset=["_x", "_y"]
    )
    if not keys:
        base = base.withColumn("_all", F.lit(1))
    pairs = stage(base.groupBy(*group, "_x", "_y").agg(F.count(F.lit(1)).alias("_n")), "pair_counts")
    hot_x, hot_y = find_hot(pairs, group, ["_x"]), find_hot(pairs, group, ["_y"])
    n_all = pairs.groupBy(*group).agg(F.sum("_n").alias("n"))
    ranked = _join_groups(pairs, _mean_ranks(pairs, group, "_x", "_rx", hot_x), [*group, "_x"])
    ranked = _join_groups(ranked, _mean_ranks(pairs, group, "_y", "_ry", hot_y), [*group, "_y"])
    ranked = _join_groups(ranked, n_all, group)
    mid = (F.col("n") + 1) / 2
    dx, dy = F.col("_rx") - mid, F.col("_ry") - mid
    sums = ranked.groupBy(*group).agg(
        F.max("n").alias("n"),
        F.sum(F.col("_n") * dx * dy).alias("_sxy"),
        F.sum(F.col("_n") * dx * dx).alias("_sxx"),
        F.sum(F.col("_n") * dy * dy).alias("_syy"),
    )
    r = F.try_divide(F.col("_sxy"), F.sqrt(F.col("_sxx") * F.col("_syy")))
    out = sums.withColumn("cor", r)
    t = F.try_divide(F.col("cor") * F.sqrt((F.col("n") - 2).cast("double")), F.sqrt(1 - F.col("cor") * F.col("cor")))
    perfect = (F.abs("cor") >= 1) & (F.col("n") > 2)
    p = F.when(perfect, 0.0).otherwise(two_sided_p(t, F.col("n") - 2))
    n, wide = F.col("n"), F.col("n").cast("double")
    most = (wide * wide * wide - wide) / 12  # of the sums of squares, reached without ties only
    untied = (F.col("_sxx") == most) & (F.col("_syy") == most) & (n <= SERIES_RANKS)
    return out.select(*keys, "n", "cor", F.when(untied & (n > 1), _rank_p(n, F.col("cor"))).when(n > 2, p).alias("p_val"))


def linear_grid(df: DataFrame, outcomes: list[str], exposures: list[str]) -> DataFrame:
    """Least squares of each outcome on each exposure: slope and p-value, all pairs in one scan."""
    rows = []
    for o in outcomes:
        for e in exposures:
            y, x = F.col(o).cast("double"), F.col(e).cast("double")
            rows.append(
                F.struct(
                    F.lit(o).alias("outcome"),
                    F.lit(e).alias("exposure"),
                    F.regr_count(y, x).alias("n"),
                    F.regr_slope(y, x).alias("estimate"),
                    F.regr_sxx(y, x).alias("sxx"),
                    F.regr_syy(y, x).alias("syy"),
                )
            )
    fits = df.agg(F.array(*rows).alias("_f")).select(F.explode("_f").alias("_f")).select("_f.*")
    b, sxx, n = F.col("estimate"), F.col("sxx"), F.col("n")
    error = F.sqrt(F.try_divide(F.greatest(F.col("syy") - b * b * sxx, F.lit(0.0)), (n - 2) * sxx))
    t = F.try_divide(b, error)
    return fits.select(
        "outcome", "exposure", "n", "estimate", F.when(n > 2, two_sided_p(t, n - 2)).alias("p_val")
    )


def cronbach_alpha(df: DataFrame, cols: list[str]) -> DataFrame:
    """Internal consistency of items over complete rows, one aggregate."""
    items = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop()
    k = len(cols)
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    parts = sum((F.var_samp(c) for c in cols[1:]), F.var_samp(cols[0]))
    return items.agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(k).alias("n_items"),
        ((1 - F.try_divide(parts, F.var_samp(total))) * (k / (k - 1))).alias("alpha"),
    )


def pca(df: DataFrame, cols: list[str]) -> DataFrame:
    """Principal components of standardised columns over complete rows.

    One row per component: sd, proportion, cumulative proportion and the
    loading of each column.  The sign makes the largest loading positive.
    One aggregate gives the correlations; only they reach the driver.
    """
    items = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop()
    pairs = [(i, j) for i in range(len(cols)) for j in range(i)]
    found = items.agg(F.count(F.lit(1)), *[F.corr(cols[i], cols[j]) for i, j in pairs]).first()  # one number per pair of columns
    matrix = np.eye(len(cols))
    for (i, j), r in zip(pairs, found[1:]):
        if r is None or math.isnan(r):
            raise ValueError(f"no correlation of {cols[i]} and {cols[j]} over {found[0]} complete rows")
        matrix[i, j] = matrix[j, i] = r
    values, vectors = np.linalg.eigh(matrix)
    rows, so_far = [], 0.0
    for n, at in enumerate(np.argsort(-values), 1):
        vector = [float(v) for v in vectors[:, at]]
        if max(vector, key=abs) < 0:
            vector = [-v for v in vector]
        part = max(float(values[at]), 0.0) / len(cols)
        so_far += part
        rows.append((f"PC{n}", (part * len(cols)) ** 0.5, part, so_far, *vector))
    fields = ", ".join(f"`{c}` double" for c in cols)
    return df.sparkSession.createDataFrame(
        rows, f"component string, sd double, proportion double, cumulative double, {fields}"
    )
