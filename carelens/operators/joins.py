"""Joins beyond a plain equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.operators.ordered import Hot, next_known, over_ordered
from carelens.operators.select import same_keys, small_side


def natural_left(a: DataFrame, b: DataFrame) -> DataFrame:
    """Left join on all shared columns."""
    return same_keys(a, b, [c for c in a.columns if c in b.columns])


def beside_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Put the columns of a one-row aggregate beside every row (a scalar subquery)."""
    row = totals.select(F.struct(*totals.columns)).scalar()
    return df.withColumn("_t", row).select(*df.columns, *[F.col(f"_t.{c}").alias(c) for c in totals.columns])


def overlap_months(spans: DataFrame, start: str, end: str, observed: DataFrame, month: str) -> DataFrame:
    """Months each closed date interval touches, among the observed months.

    The observed months within the span are picked, so a span of any length
    costs no more than the months of the extract.  A span with a missing end
    touches no month; a reversed one is turned round.
    """
    # a null bound must not be skipped by least/greatest
    known = spans.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    first = F.trunc(F.least(start, end), "MM")
    last = F.trunc(F.greatest(start, end), "MM")
    seen = observed.agg(F.collect_set(F.trunc(month, "MM"))).scalar()  # calendar months of the extract
    spans = known.withColumns({"_seen": seen, "_first": first, "_last": last})
    touched = F.filter("_seen", lambda m: m.between(F.col("_first"), F.col("_last")))
    return spans.withColumn(month, F.explode(touched)).drop("_seen", "_first", "_last")


def _dyadic(start: Column, end: Column, levels: Column) -> Column:
    """The closed range of whole numbers as an array of (level, node): disjoint blocks of 2 ^ level numbers, two of a level at most.

    At a level the range covers the blocks from ceil(start / 2 ^ level) to floor((end + 1) / 2 ^ level) - 1; the outermost of
    them stand alone when their neighbours outside belong to the same larger block.
    """

    def at(level):
        low, high = -call("shiftright", -start, level), call("shiftright", end + 1, level)
        left = F.when((low < high) & (low.bitwiseAND(F.lit(1)) == 1), F.struct(level.alias("level"), low.alias("node")))
        right = F.when((low < high) & (high.bitwiseAND(F.lit(1)) == 1), F.struct(level.alias("level"), (high - 1).alias("node")))
        return F.array_compact(F.array(left, right))

    call = F.call_function
    return F.flatten(F.transform(levels, at))


def _points_in(points: DataFrame, at: Column, ranges: DataFrame, low: Column, high: Column, keys: list[tuple[str, str]], levels: Column) -> DataFrame:
    """Every row of ``points`` beside every row of ``ranges`` of the same keys that holds its point: one equi-join."""
    points, ranges = points.withColumn("_levels", levels), ranges.withColumn("_levels", levels)
    up = F.transform("_levels", lambda k: F.struct(k.alias("level"), F.call_function("shiftright", at, k).alias("node")))
    a = points.withColumn("_p", F.explode(up)).drop("_levels")
    b = ranges.filter(low <= high).withColumn("_r", F.explode(_dyadic(low, high, F.col("_levels")))).drop("_levels")
    same = [F.col(x).eqNullSafe(F.col(y)) for x, y in keys]
    return a.join(b, [*same, F.col("_p.level") == F.col("_r.level"), F.col("_p.node") == F.col("_r.node")]).drop("_p", "_r")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], span: tuple[str, str], other: tuple[str, str] | None = None) -> DataFrame:
    """All pairs of rows of equal keys whose closed spans touch; columns of both, those of ``right`` with ``right_`` before them.

    Spans are dates or whole numbers.  Two spans touch if the left one starts within the right one, or the right one
    starts within the left one, later.  A range of numbers is a few dyadic blocks (two of each size at most) and a point lies in
    one block of each size, so a point meets a range that holds it in exactly one block: both halves are plain
    equi-joins on keys, size and block.  No pair beyond the result is formed, long spans cost the logarithm of their
    length, and a key with very many rows is spread over its blocks.

    A span with a missing end touches nothing, a reversed one is turned round, missing keys match missing keys.
    """
    other = other or span

    def bounds(df, names, prefix):
        ends = [F.unix_date(c) if df.schema[c].dataType.typeName() == "date" else F.col(c).cast("long") for c in names]
        known = df.withColumns({"_s": ends[0].cast("long"), "_e": ends[1].cast("long")}).filter("_s is not null and _e is not null")
        low, high = F.least("_s", "_e"), F.greatest("_s", "_e")
        return known.select(*[F.col(c).alias(prefix + c) for c in df.columns], low.alias(f"_{prefix}low"), high.alias(f"_{prefix}high"))

    a, b = bounds(left, span, ""), bounds(right, other, "right_")
    pairs = [(k, f"right_{k}") for k in keys]
    longest = [df.agg(F.coalesce(F.max(F.col(high) - F.col(low)), F.lit(0))).scalar() for df, low, high in ((a, "_low", "_high"), (b, "_right_low", "_right_high"))]

    def levels(most):
        return F.sequence(F.lit(0), F.floor(F.log2((most + 1).cast("double"))).cast("int") + 1)

    starts = _points_in(a, F.col("_low"), b, F.col("_right_low"), F.col("_right_high"), pairs, levels(longest[1]))
    later = _points_in(b, F.col("_right_low"), a, F.col("_low") + 1, F.col("_high"), [(y, x) for x, y in pairs], levels(longest[0]))
    columns = [*left.columns, *[f"right_{c}" for c in right.columns]]
    return starts.select(*columns).unionByName(later.select(*columns))


def asof_forward(
    left: DataFrame,
    right: DataFrame,
    key: list[str],
    left_date: str,
    right_date: str,
    left_id: str,
    out: str,
    hot: Hot | None = None,
) -> DataFrame:
    """For each left row the earliest right date of the same key on or after its own date.

    Both sides go into one ordered stream per key (one shuffle); left rows
    come before right rows of the same day, so the same day counts.
    Right rows repeat only by date, so they are reduced to distinct dates first.
    """
    dates = (
        right.select(*key, F.col(right_date).alias("_date"))
        .filter(F.col("_date").isNotNull())
        .distinct()
        .withColumns({"_side": F.lit(1), "_id": F.lit(None).cast(left.schema[left_id].dataType)})
    )
    events = left.withColumns({"_date": F.col(left_date), "_side": F.lit(0), "_id": F.col(left_id)})
    stream = events.unionByName(dates, allowMissingColumns=True)
    found = next_known(F.when(F.col("_side") == 1, F.col("_date")))
    timed = over_ordered(stream, key, ["_date", "_side", "_id"], {out: found}, hot)
    # a left row without date sorts last and must find nothing
    return timed.filter("_side = 0").select(*left.columns, out)


def asof_hot_input(left, right, key, left_date, right_date, left_id) -> DataFrame:
    """The stream `asof_forward` orders, from raw tables, as input for `find_hot`."""
    a = left.select(*key, F.col(left_date).alias("_date"), F.lit(0).alias("_side"), F.col(left_id).alias("_id"))
    b = right.select(
        *key, F.col(right_date).alias("_date"), F.lit(1).alias("_side"),
        F.lit(None).cast(left.schema[left_id].dataType).alias("_id"),
    ).distinct()
    return a.unionByName(b)


def replace_by_key(base: DataFrame, new: DataFrame, key: str, keep_prefix: str, name: str = "variable") -> DataFrame:
    """Rows of ``base`` give way to ``new`` for keys ``new`` has; names with ``keep_prefix`` stay.

    Keys of ``new`` are marked on ``base`` by one left join, so ``base`` is read once.
    """
    listed = small_side(new.select(F.col(key).alias("_key"), F.lit(True).alias("_replaced")).distinct())
    marked = base.join(listed, base[key].eqNullSafe(listed["_key"]), "left")
    stays = F.coalesce(F.col(name).startswith(keep_prefix), F.lit(False)) | F.col("_replaced").isNull()
    return new.unionByName(marked.filter(stays).select(*base.columns))


def restrict_to_cohort(events: DataFrame, cohort: DataFrame, key: str, date: str, entry: str) -> DataFrame:
    """Events of cohort members from their entry date on."""
    return same_keys(events, cohort.select(key, entry), [key], "inner").filter(F.col(date) >= F.col(entry))
