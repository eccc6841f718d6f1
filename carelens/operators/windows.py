"""Ordered operators on patient events and site series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.dates import add_days, days_between
from carelens.functions.nulls import if_else
from carelens.functions.text import pad_left
from carelens.operators.ordered import Hot, last_known, next_, over_ordered, prev, row_number, running_sum


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row per key: a combinable aggregate, no sort and no window."""
    others = [c for c in df.columns if c != key]
    at = F.struct(*[x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])
    first = df.groupBy(key).agg(F.min_by(F.struct(*others), at).alias("_f"))
    return first.select(key, "_f.*").select(*df.columns)


def assign_ids(first_visits: DataFrame, key: str, site: str, date: str, out: str, hot: Hot | None = None) -> DataFrame:
    """Patient ids: last two characters of the site, then the sequence of first visits at the site.

    Sites are few, so the numbering is the one place where a plain window
    would be a handful of huge tasks; ``hot`` cuts it by date.
    """
    numbered = row_number(first_visits, [site], [date, key], "_seq", hot)
    code = F.concat(F.right(F.col(site), F.lit(2)), F.lit("-"), pad_left(F.col("_seq").cast("string"), 4))
    return numbered.withColumn(out, code).drop("_seq")


def flag_restarts(
    df, key, order, date, days, refills, out="is_restart", min_gap=fixed.MIN_GAP_DAYS, hot: Hot | None = None
) -> DataFrame:
    """Restart of treatment: not the first row, a gap of at least ``min_gap`` days which the
    previous supply (with refills) does not cover.  An unknown supply covers nothing."""
    seen = over_ordered(
        df, key, order,
        {
            "_seen": prev(F.lit(True)),
            "_last": prev(F.col(date)),
            "_covered": prev(F.col(days) * (F.col(refills) + 1)),
        },
        hot,
    )
    gap = days_between(F.col(date), F.col("_last"))
    flag = (
        F.when(F.col("_seen").isNull(), False)
        .when(gap < min_gap, False)
        .when(gap < F.col("_covered"), False)
        .otherwise(True)
    )
    return seen.withColumn(out, flag).drop("_seen", "_last", "_covered")


def flag_breaks(df, key, order, restart="is_restart", out="is_break", hot: Hot | None = None) -> DataFrame:
    """Break after a row: it is the last one, or the next one is a restart."""
    looked = over_ordered(df, key, order, {"_next": next_(F.col(restart))}, hot)
    return looked.withColumn(out, F.coalesce("_next", F.lit(True))).drop("_next")


def flag_first(df, key, order, out="is_start", hot: Hot | None = None) -> DataFrame:
    """Whether a row is the first of its key."""
    return over_ordered(df, key, order, {"_seen": prev(F.lit(True))}, hot).withColumn(
        out, F.col("_seen").isNull()
    ).drop("_seen")


def flag_starts(df, key, order, restart="is_restart", hot: Hot | None = None) -> DataFrame:
    """First-visit flag within a cohort; the first visit is no restart."""
    return flag_first(df, key, order, "is_start", hot).withColumn(
        restart, if_else(F.col("is_start"), F.lit(False), F.col(restart))
    )


def number_episodes(df, key, order, restart="is_restart", out="episode", hot: Hot | None = None) -> DataFrame:
    """Number of the continuous treatment episode a prescription belongs to."""
    return over_ordered(df, key, order, {"_n": running_sum(F.col(restart).cast("int"))}, hot).withColumn(
        out, (F.col("_n") + 1).cast("int")
    ).drop("_n")


def episodes(df, ids, order, date, days, hot: Hot | None = None) -> DataFrame:
    """Span of each episode: first date to last date plus the last supply (refills not added)."""
    numbered = number_episodes(df, ids[:1], order, hot=hot)
    at = F.struct(*[F.col(c) for c in order])
    spans = numbered.groupBy(*ids, "episode").agg(
        F.min(date).alias("start_date"),
        F.max_by(F.struct(F.col(date).alias("d"), F.col(days).alias("s")), at).alias("_end"),
    )
    return spans.select(*ids, "episode", "start_date", add_days(F.col("_end.d"), F.col("_end.s")).alias("end_date"))


def locf(df, key, order, col, out=None, hot: Hot | None = None) -> DataFrame:
    """Carry the last known value down within a key."""
    name = out or col
    filled = over_ordered(df, key, order, {"_filled": last_known(F.col(col))}, hot)
    return filled.withColumn(name, F.col("_filled")).drop("_filled")


def zscore(df: DataFrame, cols: list[str]) -> DataFrame:
    """Standardise columns to mean 0 and sd 1 over all rows; the moments are a scalar subquery."""
    moments = df.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
        *[F.stddev_samp(c).alias(f"s_{i}") for i, c in enumerate(cols)],
    )
    row = moments.select(F.struct(*moments.columns)).scalar()
    scaled = {c: F.try_divide(F.col(c) - F.col(f"_z.m_{i}"), F.col(f"_z.s_{i}")) for i, c in enumerate(cols)}
    return df.withColumn("_z", row).withColumns(scaled).drop("_z")
