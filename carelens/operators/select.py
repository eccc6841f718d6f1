"""Projections, filters, stacking and dictionary joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.nulls import any_not_null

BROADCAST_ROWS = 100_000


def pick_columns(df: DataFrame, prefix=None, suffix=None, contains=None, drop_suffix=None) -> list[str]:
    """Names of the columns a name pattern selects; nothing is read."""
    out = df.columns
    if prefix:
        out = [c for c in out if c.startswith(prefix)]
    if suffix:
        out = [c for c in out if c.endswith(suffix)]
    if contains:
        out = [c for c in out if contains in c]
    if drop_suffix:
        out = [c for c in out if not c.endswith(drop_suffix)]
    return out


def select_pattern(df: DataFrame, keep: list[str], **pattern) -> DataFrame:
    picked = pick_columns(df, **pattern)
    return df.select(*keep, *[c for c in picked if c not in keep])


def rename_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename in one projection, so two names can be swapped; a missing column is an error."""
    missing = set(mapping) - set(df.columns)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def across(df: DataFrame, cols: list[str], fn) -> DataFrame:
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def label_with_counts(df: DataFrame, counts: dict[str, int]) -> DataFrame:
    """Put group sizes into headers: 'PC' -> 'PC (n=12)'."""
    return df.withColumnsRenamed({k: f"{k} (n={n})" for k, n in counts.items()})


def drop_withdrawn(df: DataFrame, status: str = "imp_support", code: int = fixed.WITHDRAWN) -> DataFrame:
    """Remove withdrawn sites; a missing status is removed as well."""
    return df.filter(F.col(status) != code)


def is_complete(col: Column) -> Column:
    return F.coalesce(col == fixed.FORM_COMPLETE, F.lit(False))


def keep_complete(df: DataFrame, form_status: str) -> DataFrame:
    return df.filter(F.col(form_status) == fixed.FORM_COMPLETE)


def count_incomplete(df: DataFrame, form_status: str) -> DataFrame:
    """One row: forms kept and forms discarded."""
    good = is_complete(F.col(form_status))
    return df.agg(F.count_if(good).alias("n_complete"), F.count_if(~good).alias("n_discarded"))


def filter_any_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.filter(any_not_null(cols))


def stack_tagged(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """Stack tables, name the source of each row, fill columns a table lacks with null."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def stack(*parts: DataFrame) -> DataFrame:
    """Stack tables with the same columns, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a table for broadcast when a bounded count shows that it is small.

    A larger table is returned as it is: Spark then shuffles both sides, and
    adaptive execution splits skewed join partitions.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def left_lookup(facts: DataFrame, dim: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Left join on (fact column, dim column) pairs, missing keys matching missing keys.

    Key columns of the dictionary are dropped.
    """
    renamed = dim.withColumnsRenamed({d: f"_dim_{d}" for _, d in pairs})

    def same(f, d):
        both_null = facts.schema[f].nullable and dim.schema[d].nullable
        return facts[f].eqNullSafe(renamed[f"_dim_{d}"]) if both_null else facts[f] == renamed[f"_dim_{d}"]

    cond = reduce(lambda a, b: a & b, [same(f, d) for f, d in pairs])
    return facts.join(renamed, cond, "left").drop(*[f"_dim_{d}" for _, d in pairs])


def same_keys(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on shared key columns, a missing key matching a missing key; the keys are those of ``a``.

    In a full join a row that only ``b`` has keeps its own keys.
    """
    renamed = b.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    cond = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys])
    if how != "full":
        return a.join(renamed, cond, how).drop(*[f"_same_{k}" for k in keys])
    joined = a.withColumn("_in_a", F.lit(True)).join(renamed, cond, how)
    own = {k: F.when(F.col("_in_a"), F.col(k)).otherwise(F.col(f"_same_{k}")) for k in keys}
    return joined.withColumns(own).drop("_in_a", *[f"_same_{k}" for k in keys])


def label(df: DataFrame, col: str, names: list[tuple[str, str]], out: str) -> DataFrame:
    """Display names from a literal table."""
    table = fixed.name_table(df.sparkSession, names, "_code", out)
    return left_lookup(df, F.broadcast(table), [(col, "_code")])  # literal table
