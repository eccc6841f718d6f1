"""Long and wide forms."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.operators.select import same_keys


def melt(df: DataFrame, ids: list[str], cols: list[str], name="variable", value="value", drop_null=False) -> DataFrame:
    """Wide to long: one row per id and column."""
    long = df.unpivot(ids, cols, name, value)
    return long.filter(F.col(value).isNotNull()) if drop_null else long


def melt_split(df, ids, cols, prefix, sep, names, value="value") -> DataFrame:
    """Melt and split the column name, less its prefix, into several keys.

    The name parts are literals of the plan, so nothing is parsed per row.
    """
    blocks = [
        F.struct(
            *[F.lit(part).alias(n) for part, n in zip(c.removeprefix(prefix).split(sep), names, strict=True)],
            F.col(c).try_cast("double").alias(value),
        )
        for c in cols
    ]
    return (
        df.select(*ids, F.explode(F.array(*blocks)).alias("_b"))
        .select(*ids, "_b.*")
        .filter(F.col(value).isNotNull())
    )


def melt_regex(df, ids, pattern, name="variable", value="value") -> DataFrame:
    """Melt the columns a regular expression matches; its first group names the row."""
    hits = {c: m.group(1) for c in df.columns if c not in ids and (m := re.fullmatch(pattern, c))}
    return df.select(*ids, *[F.col(c).alias(n) for c, n in hits.items()]).unpivot(ids, list(hits.values()), name, value)


def melt_blocks(df, ids, blocks: dict, number: str) -> DataFrame:
    """Repeated column blocks to rows, several value columns at once.

    ``blocks`` maps the block number to {value column: source column}.
    """
    rows = [
        F.struct(F.lit(n).alias(number), *[F.col(src).alias(out) for out, src in cols.items()])
        for n, cols in blocks.items()
    ]
    return df.select(*ids, F.explode(F.array(*rows)).alias("_b")).select(*ids, "_b.*")


def find_blocks(df: DataFrame, pattern: str) -> dict:
    """Blocks by name: group 1 of the pattern is the value column, group 2 the block number."""
    out: dict = {}
    for c in df.columns:
        if m := re.fullmatch(pattern, c):
            out.setdefault(int(m.group(2)), {})[m.group(1)] = c
    names = sorted({v for cols in out.values() for v in cols})
    uneven = [n for n, cols in out.items() if sorted(cols) != names]
    if uneven:
        raise ValueError(f"blocks with missing columns: {uneven}")
    return dict(sorted(out.items()))


def _cell(key: str, k, value: Column, fill=None) -> Column:
    here = F.col(key) == F.lit(k)
    cell = F.max(F.when(here, value))
    return cell if fill is None else F.when(F.count_if(here) == 0, F.lit(fill)).otherwise(cell)


def pivot(df, ids, key, value, keys, fill=None, prefix="") -> DataFrame:
    """Long to wide for a known key list, by one aggregation (one shuffle).

    A cell must be unique by (ids, key).  ``fill`` is used for absent cells
    only; a cell that is present with a null stays null.
    """
    return df.groupBy(*ids).agg(*[_cell(key, k, F.col(value), fill).alias(f"{prefix}{k}") for k in keys])


def pivot_glue(df, ids, key, values, keys) -> DataFrame:
    """Several value columns to wide, named '{key}_{value}'."""
    return df.groupBy(*ids).agg(*[_cell(key, k, F.col(v)).alias(f"{k}_{v}") for k in keys for v in values])


KEY_BLOCK = 4096  # keys that an id meets in one piece


def densify(df, ids: list[str], key: str, value: str, fill=0, within: list[str] = ()) -> DataFrame:
    """Every observed id with every observed key, ``fill`` where a pair is missing.

    ``within`` names those of the id columns that have key sets of their own
    (a measure and its months).  ``df`` is read three times, best a kept table.
    The grid is the result asked for; it is formed by an equi-join: distinct
    keys are dealt into blocks of about ``KEY_BLOCK`` by hash, each id goes to
    every block of its key set, and meets the keys there.  No list of keys is
    collected, so there may be any number of them, and the join can be split.
    A missing key is no key; an id whose keys are all missing has no row.
    """
    per = list(within)
    keys = df.filter(F.col(key).isNotNull()).select(*per, key).distinct()
    blocks = F.ceil(F.count(F.lit(1)) / KEY_BLOCK).cast("int")
    if per:
        sizes = keys.groupBy(*per).agg(blocks.alias("_blocks"))
        keys = same_keys(keys, sizes, per)
        rows = same_keys(df.select(*ids).distinct(), sizes, per, "inner")
    else:
        size = keys.agg(F.greatest(blocks, F.lit(1))).scalar()
        keys, rows = keys.withColumn("_blocks", size), df.select(*ids).distinct().withColumn("_blocks", size)
    dealt = keys.select(*per, key, F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int").alias("_block"))
    rows = rows.select(*ids, F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
    grid = same_keys(rows, dealt, [*per, "_block"], "inner").select(*ids, key)
    known = df.select(*ids, key, value, F.lit(True).alias("_known"))
    joined = same_keys(grid, known, [*ids, key])
    return joined.select(
        *ids, key, F.when(F.col("_known").isNull(), F.lit(fill)).otherwise(F.col(value)).alias(value)
    )


def explode_list(df, col, sep=",", as_type=None) -> DataFrame:
    """Delimited text to rows."""
    item = F.trim(F.col("_item"))
    return (
        df.withColumn("_item", F.explode_outer(F.split(F.col(col), sep)))
        .withColumn(col, item.try_cast(as_type) if as_type else item)
        .drop("_item")
    )


def unite_onehot(df, prefix: str, out: str) -> DataFrame:
    """Check-box columns to one text of the ticked codes ('1_3'), unticked and missing skipped."""
    boxes = [c for c in df.columns if c.startswith(prefix)]
    text = F.concat_ws("_", *[F.when(F.col(c) == 1, c[-1]) for c in boxes])
    return df.withColumn(out, text).drop(*boxes)


def crosstab(df, keys, cat, cats) -> DataFrame:
    """Counts by key and category with zeros."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col(cat) == c).alias(c) for c in cats])


def name_grid(df: DataFrame, lists: dict[str, list[str]]) -> DataFrame:
    """All combinations of short literal lists, for each row of ``df``."""
    for name, values in lists.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df
