"""Temperature mixing of sources, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.sources.staging import stage

LEVELS = 4  # halvings of the exponent's interval in one pass over the sources
PASSES = 8  # the exponent is then a multiple of 2 ** -32


def n_tokens(text: Column) -> Column:
    """Words: runs of anything but space, tab, line feed, vertical tab, form feed and carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(seed: str, turn: Column, key: Column) -> Column:
    """Place of a document in the permutation of one pass over its source: 32 hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(seed), turn.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))


def block_of(order: Column, blocks: int) -> Column:
    """Block of a place; blocks follow each other in the order of the places."""
    return F.floor(F.conv(F.left(order, F.lit(8)), 16, 10).cast("long") * blocks / F.lit(1 << 32)).cast("long")


def find_exponent(sources: DataFrame, target_entropy: float | None, max_repeats: float | None, budget: int | None) -> float:
    """The smallest exponent from 0 to 1 that keeps entropy and repetition within their limits.

    Bisection, several halvings at a time: each pass over the sources evaluates all the points these would visit.
    Without a limit, or where none holds even at 1, the shares stay as they are.
    """
    total = sources.agg(F.sum("_n").alias("n"), F.max("_n").alias("most")).first()
    if not total["n"]:
        return 1.0
    share = F.col("_n") / F.lit(float(total["n"]))
    positive = sources.where("_n > 0")

    def within(exponents: list[float]) -> list[bool]:
        columns = []
        for i, a in enumerate(exponents):
            p = F.pow(share, F.lit(a))
            repeats = F.pow(F.col("_n") / F.lit(float(total["most"])), F.lit(a - 1.0)) if budget is None else F.pow(share, F.lit(a)) / F.col("_n")
            columns += [F.sum(p).alias(f"z{i}"), F.sum(p * F.log(p)).alias(f"e{i}"), F.max(repeats).alias(f"r{i}")]
        got = positive.agg(*columns).first()
        out = []
        for i in range(len(exponents)):
            z = got[f"z{i}"]
            entropy = math.log(z) - got[f"e{i}"] / z
            repeats = got[f"r{i}"] if budget is None else got[f"r{i}"] / z * budget
            out.append((target_entropy is None or entropy <= target_entropy) and (max_repeats is None or repeats <= max_repeats))
        return out

    low, high = 0.0, 1.0
    if within([0.0])[0]:
        return 0.0
    for _ in range(PASSES):
        step = (high - low) / (1 << LEVELS)
        points = [low + step * i for i in range(1, 1 << LEVELS)]
        good = within(points)
        first = good.index(True) if True in good else len(points)
        low, high = (points[first - 1] if first else low), (points[first] if first < len(points) else high)
    return high


def mix_plan(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None, budget: int | None = None,
             seed: str = "mix", key: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Documents (_key, _source, _tokens) and sources with their weight, whole passes and the cut of the last pass.

    A source's weight is its token share to the exponent, normalised.  Its budget of tokens is its weight times
    ``budget``; without a budget, the smallest one that gives every source at least one whole pass.  Whole passes take
    every document; the last one takes those up to the cut, the longest beginning of the source's permutation that
    stays within the budget.  The cut is found among blocks of the permutation first, then within one block, so that
    a source with a third of all documents is never sorted in one task.
    """
    rows = stage(docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), n_tokens(F.col(text)).alias("_tokens")), "tokens")
    shares = stage(rows.groupBy("_source").agg(F.sum("_tokens").alias("_n")), "shares")
    exponent = find_exponent(shares, target_entropy, max_repeats, budget)
    count = rows.count()
    blocks = max(1, math.isqrt(count))
    sums = shares.agg(F.max("_n").alias("most"), F.sum("_n").alias("n"), F.sum(F.when(F.col("_n") > 0, F.pow(F.col("_n") / F.lit(1.0), F.lit(exponent)))).alias("z")).first()
    most, z = float(sums["most"] or 1) or 1.0, float(sums["z"] or 1.0)
    weight = F.when(F.col("_n") > 0, F.pow(F.col("_n") / F.lit(1.0), F.lit(exponent)) / F.lit(z)).otherwise(F.lit(0.0))
    tokens = (
        F.floor(F.col("_n") * F.pow(F.col("_n") / F.lit(most), F.lit(exponent - 1.0))) if budget is None else F.floor(weight * F.lit(float(budget)))
    )
    planned = shares.withColumn("_weight", weight).withColumn("_budget", F.when(F.col("_n") > 0, tokens).otherwise(F.lit(0)).cast("long"))
    planned = planned.select(
        F.col("_source").alias("_of"), "_weight", "_budget",
        F.when(F.col("_n") > 0, F.floor(F.col("_budget") / F.col("_n"))).otherwise(F.lit(1)).cast("long").alias("_whole"),
        F.when(F.col("_n") > 0, F.col("_budget") % F.col("_n")).otherwise(F.lit(0)).alias("_rest"),
    )
    order = order_key(seed, F.col("_whole"), F.col("_key"))
    placed = (
        rows.join(planned, F.col("_source").eqNullSafe(F.col("_of"))).where("_rest > 0")
        .select("_of", "_rest", "_tokens", order.alias("_order")).withColumn("_block", block_of(F.col("_order"), blocks))
    )
    before = Window.partitionBy("_of").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    cut_block = (
        placed.groupBy("_of", "_rest", "_block").agg(F.sum("_tokens").alias("_t"))
        .withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0)))
        .where("_before <= _rest AND _before + _t > _rest")
        .select(F.col("_of").alias("_cut_of"), F.col("_block").alias("_cut_block"), "_before")
    )
    running = Window.partitionBy("_of").orderBy("_order").rangeBetween(Window.unboundedPreceding, 0)  # equal rows stay together
    inside = (
        placed.join(cut_block, F.col("_of").eqNullSafe(F.col("_cut_of")) & (F.col("_block") == F.col("_cut_block")))
        .withColumn("_sum", F.col("_before") + F.sum("_tokens").over(running))
        .groupBy("_of", "_cut_block").agg(F.max(F.when(F.col("_sum") <= F.col("_rest"), F.col("_order"))).alias("_cut_order"))
        .select(F.col("_of").alias("_cut_of"), "_cut_block", "_cut_order")
    )
    cuts = planned.join(inside, F.col("_of").eqNullSafe(F.col("_cut_of")), "left").drop("_cut_of")
    return rows, stage(cuts.withColumn("_blocks", F.lit(blocks)), "sources")


def passes_of(rows: DataFrame, sources: DataFrame, seed: str = "mix") -> DataFrame:
    """Add ``_passes``, how often each row is taken.  ``rows`` has _key and _source; it may have any other columns."""
    order = order_key(seed, F.col("_whole"), F.col("_key"))
    joined = rows.join(sources.select("_of", "_whole", "_rest", "_cut_block", "_cut_order", "_blocks"), F.col("_source").eqNullSafe(F.col("_of")))
    joined = joined.withColumn("_order", F.when(F.col("_rest") > 0, order)).withColumn("_block", F.floor(F.conv(F.left("_order", F.lit(8)), 16, 10).cast("long") * F.col("_blocks") / F.lit(1 << 32)))
    extra = (F.col("_block") < F.col("_cut_block")) | ((F.col("_block") == F.col("_cut_block")) & (F.col("_order") <= F.col("_cut_order")))
    taken = F.col("_whole") + F.when(F.col("_rest") > 0, F.coalesce(extra, F.lit(False)).cast("int")).otherwise(F.lit(0))
    return joined.withColumn("_passes", taken.cast("int")).drop("_of", "_whole", "_rest", "_cut_block", "_cut_order", "_blocks", "_order", "_block")


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None, budget: int | None = None,
        seed: str = "mix", key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """A mixture as rows of (document, pass): key, source, n_tokens, pass (from 0), block, place.

    In each pass a source's documents come in the order of ``place``, a permutation of its own, in blocks.  Missing
    sources are one source.  A missing or empty text has no tokens: it costs nothing, and a source without any tokens
    is taken once.  Missing keys stay; rows that repeat share a place and are taken or left together.  An empty table
    gives an empty result; other columns are ignored.
    """
    rows, sources = mix_plan(docs, target_entropy, max_repeats, budget, seed, key, text, source)
    blocks = max(1, math.isqrt(rows.count()))
    taken = passes_of(rows, sources, seed).where("_passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("_passes") - 1)))
    place = order_key(seed, F.col("pass"), F.col("_key"))
    return taken.select(
        F.col("_key").alias(key), F.col("_source").alias(source), F.col("_tokens").alias("n_tokens"), "pass", block_of(place, blocks).alias("block"), place.alias("place")
    )


def realise(docs: DataFrame, sources: DataFrame, seed: str = "mix", key: str = "doc_id", source: str = "source") -> DataFrame:
    """The documents themselves, each row as often as the plan takes it, with their own columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    rows = rows.withColumn("_key", F.col(names[docs.columns.index(key)])).withColumn("_source", F.col(names[docs.columns.index(source)]))
    taken = passes_of(rows, sources, seed).where("_passes > 0")
    return taken.withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("_passes")))).select(*names).toDF(*docs.columns)
