"""Ordered computations within a key that stay balanced when one key is huge.

A window partitioned by a key puts all rows of that key into one task.  Keys
here are sites (a few dozen, so each holds a large share) and patients (an
"unknown" patient may hold a third of a table).  `find_hot` takes a bounded
sample and cuts every heavy key into slices along the order columns;
`over_ordered` then runs the window by (key, slice) and carries the value at
the edge of a slice into the next one.  The result does not depend on the
sample: slices only decide where the work runs.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLES_PER_SLICE = 10
MIN_SAMPLE = 2_000
MAX_SAMPLE = 200_000
ROWS_WORTH_CUTTING = 100


@dataclass(frozen=True)
class Hot:
    """Slice bounds of the heavy keys: one row per key, at most a few thousand; every ``_step``-th one apart."""

    keys: list[str]
    order: list[str]
    bounds: DataFrame


def _ordering(cols: list[str]) -> Column:
    """Sortable value of the order columns, nulls last."""
    return F.struct(
        *[c for i, name in enumerate(cols) for c in (F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}"))]
    )


def _sort_cols(cols: list[str], descending: bool = False) -> list[Column]:
    if descending:
        return [F.col(c).desc_nulls_first() for c in cols]
    return [F.col(c).asc_nulls_last() for c in cols]


def sample_size(spark) -> int:
    """Rows a sample should have: more for more parallelism, within fixed bounds."""
    return min(MAX_SAMPLE, max(MIN_SAMPLE, 20 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def draw(df: DataFrame, rows: int | None = None) -> list:
    """A bounded uniform sample of ``df``, which has ``rows`` rows (counted when not given)."""
    rows = df.count() if rows is None else rows
    fraction = sample_size(df.sparkSession) / max(rows, 1)
    return (df if fraction >= 1 else df.sample(fraction, seed=7)).collect()


def cut_heavy(
    df: DataFrame, keys: list[str], order: list[str], sample: list, slice_rows: int = SAMPLES_PER_SLICE
) -> Hot | None:
    """Slice bounds of the keys that are frequent in a sample of ``df``; None when there are none."""
    hits = defaultdict(list)
    for row in sample:
        hits[tuple(row[k] for k in keys)].append(tuple(x for c in order for x in (row[c] is None, row[c])))
    heavy = []
    for key, found in hits.items():
        if len(found) >= 2 * slice_rows:
            found.sort()
            bounds = sorted(set(found[slice_rows::slice_rows]))
            step = max(1, math.isqrt(len(bounds)))
            heavy.append((*key, bounds, bounds[::step], step))
    if not heavy:
        return None
    types = {f.name: f.dataType for f in df.schema.fields}
    edge = T.StructType(
        [
            field
            for i, name in enumerate(order)
            for field in (T.StructField(f"n{i}", T.BooleanType()), T.StructField(f"v{i}", types[name]))
        ]
    )
    schema = T.StructType(
        [T.StructField(f"_hot_{k}", types[k]) for k in keys]
        + [T.StructField("_bounds", T.ArrayType(edge)), T.StructField("_coarse", T.ArrayType(edge)), T.StructField("_step", T.IntegerType())]
    )
    return Hot(list(keys), list(order), df.sparkSession.createDataFrame(heavy, schema))


def find_hot(df: DataFrame, keys: list[str], order: list[str], slice_rows: int = SAMPLES_PER_SLICE) -> Hot | None:
    """Heavy keys of ``df`` and the bounds that cut them.

    Call it on the raw table the key comes from: two narrow scans, no shuffle.
    A table of a few hundred rows per slice wanted is not worth cutting: all of
    it fits one task.
    """
    narrow = df.select(*keys, *[c for c in order if c not in keys])
    rows = narrow.count()
    if rows <= ROWS_WORTH_CUTTING * slice_rows:
        return None
    return cut_heavy(narrow, keys, order, draw(narrow, rows), slice_rows)


def _same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def prev(col) -> tuple[str, Column]:
    """Value in the row before, null at the first row of the key."""
    return "prev", col


def next_(col) -> tuple[str, Column]:
    """Value in the row after, null at the last row of the key."""
    return "next", col


def running_sum(col) -> tuple[str, Column]:
    """Sum from the first row of the key up to this row."""
    return "running_sum", col


def last_known(col) -> tuple[str, Column]:
    """Latest non-null value up to this row."""
    return "last_known", col


def next_known(col) -> tuple[str, Column]:
    """Earliest non-null value from this row on."""
    return "next_known", col


def _local(kind: str, col: Column, up: Window, down: Window) -> Column:
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if kind == "prev":
        return F.lag(col).over(up)
    if kind == "next":
        return F.lead(col).over(up)
    if kind == "running_sum":
        return F.sum(col).over(up.rowsBetween(*so_far))
    if kind == "last_known":
        return F.last(col, ignorenulls=True).over(up.rowsBetween(*so_far))
    # a frame that ends at the last row costs n^2 in Spark; the reversed order does not
    return F.last(col, ignorenulls=True).over(down.rowsBetween(*so_far))


def _edge(kind: str, col: Column, at: Column) -> Column:
    """What a slice hands over to its neighbour."""
    if kind == "running_sum":
        return F.sum(col)
    if kind == "prev":
        return F.max_by(F.struct(col.alias("x")), at)["x"]
    if kind == "next":
        return F.min_by(F.struct(col.alias("x")), at)["x"]
    known = F.when(col.isNotNull(), at)
    return F.max_by(col, known) if kind == "last_known" else F.min_by(col, known)


def _carry(kind: str, col: Column, slices: Window) -> Column:
    before = slices.rowsBetween(Window.unboundedPreceding, -1)
    if kind == "prev":
        return F.lag(col).over(slices)
    if kind == "next":
        return F.lead(col).over(slices)
    if kind == "running_sum":
        return F.sum(col).over(before)
    if kind == "last_known":
        return F.last(col, ignorenulls=True).over(before)
    after = slices.rowsBetween(1, Window.unboundedFollowing)
    return F.first(col, ignorenulls=True).over(after)


def over_ordered(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    steps: dict[str, tuple[str, Column]],
    hot: Hot | None = None,
) -> DataFrame:
    """Add the columns ``steps`` computed in the order of ``order`` within ``keys``.

    ``order`` must end in a row id so that it has no ties.  ``hot`` comes from
    `find_hot` on a table with the same key and order columns.
    """
    if hot is None:
        up = Window.partitionBy(*keys).orderBy(*_sort_cols(order))
        down = Window.partitionBy(*keys).orderBy(*_sort_cols(order, descending=True))
        return df.withColumns({name: _local(kind, col, up, down) for name, (kind, col) in steps.items()})

    work = df.withColumns({f"_in_{name}": col for name, (_, col) in steps.items()})
    bounds = F.broadcast(hot.bounds)  # bounded: MAX_SAMPLE / SAMPLES_PER_SLICE entries
    work = work.join(bounds, _same(work, bounds, [(k, f"_hot_{k}") for k in keys]), "left")
    # the number of bounds up to this row: among every _step-th one first, then among those of that stretch
    at = _ordering(order)
    work = work.withColumn("_from", F.greatest((F.size(F.filter("_coarse", lambda b: b <= at)) - 1) * F.col("_step"), F.lit(0)))
    within = F.filter(F.slice("_bounds", F.col("_from") + 1, F.col("_step")), lambda b: b <= at)
    work = work.withColumn(
        "_slice", F.when(F.col("_bounds").isNull(), 0).otherwise(F.col("_from") + F.size(within))
    ).withColumn("_hot", F.col("_bounds").isNotNull()).drop("_bounds", "_coarse", "_step", "_from", *[f"_hot_{k}" for k in keys])

    up = Window.partitionBy(*keys, "_slice").orderBy(*_sort_cols(order))
    down = Window.partitionBy(*keys, "_slice").orderBy(*_sort_cols(order, descending=True))
    kinds = {kind for kind, _ in steps.values()}
    local = {f"_loc_{n}": _local(kind, F.col(f"_in_{n}"), up, down) for n, (kind, _) in steps.items()}
    if "prev" in kinds:
        local["_top"] = F.lag(F.lit(True)).over(up).isNull()
    if "next" in kinds:
        local["_end"] = F.lead(F.lit(True)).over(up).isNull()
    placed = work.withColumns(local)

    edges = (
        work.filter("_hot")
        .groupBy(*keys, "_slice")
        .agg(*[_edge(kind, F.col(f"_in_{n}"), at).alias(f"_edge_{n}") for n, (kind, _) in steps.items()])
    )
    slices = Window.partitionBy(*keys).orderBy("_slice")
    edges = edges.select(
        *[F.col(k).alias(f"_e_{k}") for k in keys],
        F.col("_slice").alias("_e_slice"),
        *[_carry(kind, F.col(f"_edge_{n}"), slices).alias(f"_edge_{n}") for n, (kind, _) in steps.items()],
    )
    edges = F.broadcast(edges)  # one row per slice of a heavy key: same bound as above
    pairs = [(k, f"_e_{k}") for k in keys] + [("_slice", "_e_slice")]
    joined = placed.join(edges, _same(placed, edges, pairs), "left")
    out = {}
    for name, (kind, _) in steps.items():
        here, over = F.col(f"_loc_{name}"), F.col(f"_edge_{name}")
        if kind == "prev":
            out[name] = F.when(F.col("_top"), over).otherwise(here)
        elif kind == "next":
            out[name] = F.when(F.col("_end"), over).otherwise(here)
        elif kind == "running_sum":
            out[name] = F.coalesce(here + over, here, over)
        else:
            out[name] = F.coalesce(here, over)
    return joined.select(*[c for c in df.columns if c not in steps], *[c.alias(n) for n, c in out.items()])


def row_number(df: DataFrame, keys: list[str], order: list[str], name: str, hot: Hot | None = None) -> DataFrame:
    """Sequence number within the key."""
    return over_ordered(df, keys, order, {name: running_sum(F.lit(1).cast("bigint"))}, hot)
