"""Column expressions whose null rules differ from plain SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def if_else(cond: Column, yes, no) -> Column:
    """Two-way choice that is null when the condition is null."""
    return F.when(cond, yes).when(~cond, no)


def recode(col: Column, mapping: dict, default=None) -> Column:
    """Replace listed values; anything else becomes ``default``."""
    out = reduce(
        lambda acc, kv: acc.when(col == F.lit(kv[0]), F.lit(kv[1])),
        list(mapping.items())[1:],
        F.when(col == F.lit(next(iter(mapping))), F.lit(next(iter(mapping.values())))),
    )
    return out.otherwise(F.lit(default))


def null_sum(a: Column, b: Column) -> Column:
    """a + b, null only when both are null."""
    return F.coalesce(a + b, a, b)


def pct_clamped(n: Column, d: Column) -> Column:
    """n/d as percent: null for d = 0, 100 when n exceeds d."""
    return F.when(d == 0, None).when(n > d, 100.0).otherwise(F.try_divide(n, d) * 100)


def pct_zero_default(n: Column, d: Column) -> Column:
    """n/d as percent: 0 for d = 0 or missing n, 100 when n exceeds d, null for missing d."""
    return (
        F.when((d == 0) | n.isNull(), 0.0)
        .when(d.isNull(), None)
        .when(n > d, 100.0)
        .otherwise(F.try_divide(n, d) * 100)
    )


def percent(n: Column, d: Column) -> Column:
    """Plain n/d*100, null for d = 0."""
    return F.try_divide(n, d) * 100


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def tokens_to_null(col: Column, tokens: list[str]) -> Column:
    return F.when(~F.trim(col).isin(tokens), col)


def try_number(col: Column) -> Column:
    return col.try_cast("double")


def strict(agg, col: Column) -> Column:
    """Aggregate that is null when any input of the group is null."""
    return F.when(F.count(col) == F.count(F.lit(1)), agg(col))


def weighted_mean(col: Column, weight: Column) -> Column:
    """Mean of rows that stand for several answers each, nulls ignored."""
    return F.try_divide(F.sum(col * weight), F.sum(F.when(col.isNotNull(), weight)))


def n_unique(col: Column) -> Column:
    """Distinct values of a group, a missing value counting as one more."""
    return F.count_distinct(col) + F.max(col.isNull().cast("int"))


def any_not_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])


def row_mean(cols: list[str]) -> Column:
    """Mean of several columns in a row, nulls ignored; null when all are null."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    known = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return F.try_divide(total, known)
