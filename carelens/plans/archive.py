"""Older measure set computed from a patient registry, for one search month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.dates import add_days, days_between, month_end
from carelens.operators.joins import beside_totals
from carelens.operators.reshape import melt_blocks

PARTS = ["prescriber", "location", "date", "duration"]


def registry_long(register: DataFrame, refills: int = 6) -> DataFrame:
    """One row per prescription; 0 is the initial one.  Days off since the supply before it, and restart flag.

    The prescription before stands in the same wide row, so nothing is sorted or shuffled.
    """
    names = ["init", *[f"refill{n}" for n in range(1, refills + 1)]]
    blocks = {n: {p: f"{name}_{p}" for p in PARTS} for n, name in enumerate(names)}
    ends = {f"_until_{n}": add_days(F.col(f"{names[n - 1]}_date"), F.col(f"{names[n - 1]}_duration")) if n else F.lit(None).cast("date") for n in blocks}
    blocks = {n: {**cols, "_until": f"_until_{n}"} for n, cols in blocks.items()}
    ids = ["ID", "admit_date", "diag_date", "disc_date", "MOUD_type"]
    long = melt_blocks(register.withColumns(ends), ids, blocks, "refill")
    off = days_between(F.col("date"), F.col("_until"))
    return long.withColumns({"days_off_rx": off, "is_restart": off > fixed.RESTART_AFTER_DAYS_OFF}).drop("_until")


def within_month(date: Column, start: str) -> Column:
    first = F.lit(start).cast("date")
    return date.between(first, month_end(first))


def registry_measures(long: DataFrame, month: str) -> DataFrame:
    """One row with all measures of the month; shares are of b5.

    b5 adds the two drugs, so a patient on both counts twice.  Patients and
    prescribers are reduced to one row of flags each, then the flags are
    counted; a missing prescriber counts as one.
    """
    recent, drug = within_month(F.col("date"), month), F.col("MOUD_type")
    flags = {
        "b1": within_month(F.col("admit_date"), month),
        "b2": F.col("disc_date").isNull(),
        "b3": recent & (drug == "Buprenorphine"),
        "b4": recent & (drug == "Naltrexone"),
        "n_new": recent & (F.col("refill") == 0),
        "n_restart": recent & F.col("is_restart"),
        "c1": days_between(F.col("date"), F.col("diag_date")) <= 3,
    }
    places = {"a1": recent & (F.col("location") == "Onsite"), "a2": recent & (F.col("location") == "Offsite")}

    def counted(key, conds):
        seen = long.groupBy(key).agg(*[F.bool_or(c).alias(n) for n, c in conds.items()])
        return seen.agg(*[F.count_if(F.col(n)).alias(n) for n in conds])

    counts = beside_totals(counted("ID", flags), counted("prescriber", places))
    b5 = F.col("b3") + F.col("b4")
    return counts.select(
        "a1", "a2", (F.col("a1") + F.col("a2")).alias("a3"), "b1", "b2", "b3", "b4", b5.alias("b5"),
        F.try_divide(F.col("n_new"), b5).alias("b6"), F.try_divide(F.col("n_restart"), b5).alias("b7"), "c1",
    )
