"""Exact order statistics and moments of many columns and groups at once, by histograms that are refined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.operators.select import same_keys, small_side
from carelens.sources.staging import stage

STEPS = 16  # stretches of a doubling in the first histogram
BINS = 4096  # of a stretch in each later one
FEW = 100_000  # values looked at one by one


def _stretch(v: Column) -> Column:
    """Number of the stretch a value lies in, in the order of the values; a sixteenth of a doubling each."""
    size = F.floor(F.log2(F.abs(v)) * STEPS) + 20_000
    finite = F.when(v == 0, 0).when(v > 0, size).otherwise(-size)
    return F.when(F.isnan(v), 1_000_000).when(F.abs(v) == float("inf"), F.signum(v).cast("long") * 900_000).otherwise(finite)


def _counted(rows: DataFrame, group: list[str], *extra: Column) -> tuple[DataFrame, DataFrame]:
    """A histogram: rows, least and largest value of each bin; and with how many rows of the group stand before it."""
    counts = stage(rows.groupBy(*group, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), *extra), "histogram")
    before = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # at most some thousand bins of a group
    return counts, counts.filter("_bin is not null").withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def _met(targets: DataFrame, bins: DataFrame, group: list[str]) -> DataFrame:
    """Each target with the bin that holds its rank, and its rank within that bin."""
    found = same_keys(targets, bins.select(*group, "_n", "_low", "_high", "_before"), group, "inner")
    found = found.filter((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
    return found.withColumn("_rank", F.col("_rank") - F.col("_before")).drop("_before")


def ranked_summary(rows: DataFrame, group: list[str], probs: dict[str, float]) -> DataFrame:
    """Per group of ``rows`` (group columns and ``_v``, a double): _total, _missing, mean, _ss, min, max and the quantiles.

    The first scan counts each group's values in stretches of a sixteenth of a doubling, with their moments.  A rank
    lies in one stretch; a stretch of one value is the answer, others are cut into 4,096 bins by a further scan, and
    so on: at most five for any doubles, two or three as a rule, one for few distinct values.  A scan shuffles a row per
    group, bin and task, whatever the number of values.  When few values are left in all, they are their own bins.

    Nulls are missing; quantiles are interpolated; groups without values have nulls; not-a-number is the largest value.
    Counts that change from scan to scan end in an error.  Needs at least one group column.
    """
    rows = rows.withColumn("_v", F.col("_v") + 0.0)  # no negative zero
    counts, bins = _counted(
        rows.withColumn("_bin", _stretch(F.col("_v"))), group, F.avg("_v").alias("_m"), (F.var_pop("_v") * F.count("_v")).alias("_s")
    )
    known = F.col("_bin").isNotNull()
    times = F.when(known, F.col("_n"))
    totals = counts.groupBy(*group).agg(
        F.coalesce(F.sum(times), F.lit(0)).alias("_total"), F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("_missing"),
        F.try_divide(F.sum(times * F.col("_m")), F.sum(times)).alias("mean"), F.min("_low").alias("min"), F.max("_high").alias("max"),
    )
    totals = stage(totals, "totals")
    away = F.col("_m") - F.col("mean")
    spread = same_keys(counts.filter(known), totals.select(*group, "mean"), group).groupBy(*group).agg(F.sum(F.col("_s") + F.col("_n") * away * away).alias("_ss"))

    spots = {name: (F.col("_total") - 1) * F.lit(float(p)) for name, p in probs.items()}
    ends = [F.struct(F.lit(name).alias("_name"), F.lit(top).alias("_top"), (F.ceil(s) if top else F.floor(s)).alias("_rank")) for name, s in spots.items() for top in (False, True)]
    targets = totals.filter("_total > 0").select(*group, F.explode(F.array(*ends)).alias("_t")).select(*group, "_t.*")
    wanted = 2 * len(probs) * totals.filter("_total > 0").count()
    found = stage(_met(targets, bins, group), "found")
    answers = found.filter(F.col("_low") == F.col("_high"))
    while True:
        if found.count() != wanted:
            raise RuntimeError("a wanted rank is not in its bracket: the input changed between two scans")
        left = found.filter(F.col("_low") != F.col("_high"))
        brackets = stage(left.select(*group, "_low", "_high", "_n").distinct(), "brackets")
        size = brackets.agg(F.sum("_n")).first()[0]
        if size is None:
            break
        open_ = brackets.select(*[F.col(c).alias(f"_of_{c}") for c in group], F.col("_low").alias("_from"), F.col("_high").alias("_to"))
        v, low, high = F.col("_v"), F.col("_from"), F.col("_to")
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group]
        inside = rows.join(small_side(open_), [*same, v >= low, v <= high])
        part = F.least(F.floor((v - low) / (high - low) * BINS), F.lit(BINS - 1)).cast("double")
        inside = inside.select(*group, "_from", "_to", "_v", (v if size <= FEW else part).alias("_bin"))
        _, bins = _counted(inside, [*group, "_from", "_to"])
        wanted = left.count()
        narrowed = left.select(*group, "_name", "_top", "_rank", F.col("_low").alias("_from"), F.col("_high").alias("_to"), F.col("_n").alias("_had"))
        checked = bins.groupBy(*group, "_from", "_to").agg(F.sum("_n").alias("_has"))
        narrowed = same_keys(narrowed, checked, [*group, "_from", "_to"]).filter("_had = _has").drop("_had", "_has")
        found = stage(_met(narrowed, bins, [*group, "_from", "_to"]).drop("_from", "_to"), "found")
        answers = answers.unionByName(found.filter(F.col("_low") == F.col("_high")))
    at = lambda name, top: F.max(F.when((F.col("_name") == name) & (F.col("_top") == F.lit(top)), F.col("_low")))
    ends = answers.groupBy(*group).agg(*[at(name, top).alias(f"_{'hi' if top else 'lo'}_{name}") for name in probs for top in (False, True)])
    out = same_keys(same_keys(totals, spread, group), ends, group)
    values = {}
    for name, spot in spots.items():
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        values[name] = F.when(lo == hi, lo).otherwise(lo + (spot - F.floor(spot)) * (hi - lo))
    return out.select(*group, "_total", "_missing", "mean", "_ss", "min", "max", *[c.alias(n) for n, c in values.items()])


def sample_sd(total: str = "_total", squares: str = "_ss") -> Column:
    return F.when(F.col(total) > 1, F.sqrt(F.col(squares) / (F.col(total) - 1)))
