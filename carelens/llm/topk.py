"""Exact top-k search by refining global histograms of scores."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import batch, ship
from carelens.sources.staging import new_folder, save_stage

BLOCK = 2048  # vectors in a stored block
WAVE = 4096  # queries sent to the tasks at once: WAVE * dimensions * 8 bytes
BINS = 512  # of a histogram
CELLS = 1_000_000  # scores a task holds at once
EXACT = 2.0**53
TOP = 2**63 - 1

BLOCKS = pa.schema([("dim", pa.int32()), ("kind", pa.string()), ("reach", pa.float64()), ("ids", pa.binary()), ("cells", pa.binary())])
COUNTS = pa.schema([("q", pa.int32()), ("bin", pa.int64()), ("need", pa.int64()), ("n", pa.int64())])
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def floored(values: np.ndarray, scale: float) -> tuple[np.ndarray, float]:
    """floor(scale * x) and the largest size; where a double cannot hold that, whole numbers of any size, and infinity."""
    with np.errstate(over="ignore"):
        cells = np.floor(scale * values)
    if np.isfinite(cells).all():
        return cells, float(np.abs(cells).max()) if cells.size else 0.0
    whole = [int(c) if np.isfinite(c) else math.floor(Fraction(x) * Fraction(scale)) for c, x in zip(cells.ravel().tolist(), values.ravel().tolist())]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(values.shape), float("inf")


def _pack(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Floored vectors in blocks of one length each, as the narrowest floats that hold them exactly, or as text."""
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        lists = b.column(1)
        dims = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.concatenate([[0], np.cumsum(dims)[:-1]]) if len(dims) else dims
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            for s in range(0, len(at), BLOCK):
                rows = at[s : s + BLOCK]
                cells, reach = floored(flat[starts[rows][:, None] + np.arange(d)[None, :]], scale)
                kind = "text" if cells.dtype == object else "f4" if reach <= 2**24 else "f8"
                stored = " ".join(map(str, cells.ravel())).encode() if kind == "text" else cells.astype(f"<{kind}").tobytes()
                yield batch(BLOCKS, [int(d)], [kind], [reach], [ids[rows].astype("<i8").tobytes()], [stored])


def _blocks(b: pa.RecordBatch) -> Iterator[tuple[int, float, np.ndarray, np.ndarray]]:
    for r in b.to_pylist():
        ids = np.frombuffer(r["ids"], "<i8")
        if r["kind"] == "text":
            cells = np.array([int(x) for x in r["cells"].split()], object)
        else:
            cells = np.frombuffer(r["cells"], f"<{r['kind']}").astype(np.float64)
        yield r["dim"], r["reach"], ids, cells.reshape(len(ids), r["dim"])


def _scores(queries: np.ndarray, reach_q: float, vectors: np.ndarray, reach: float) -> np.ndarray:
    """Integer inner products: by floating point where that is exact, else by whole numbers of any size."""
    if reach_q * reach * max(1, queries.shape[1]) < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    exact = [[int(x) for x in row] for row in vectors]
    out = [[max(-TOP, min(TOP, sum(a * b for a, b in zip(q, v)))) for v in exact] for q in ([int(x) for x in row] for row in queries)]
    return np.array(out, dtype=np.int64).reshape(len(queries), len(vectors))


def _scored(batches: Iterator[pa.RecordBatch], wave: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(queries, ids, scores): a query's own rows are marked by the lowest value, which no score takes."""
    for b in batches:
        for dim, reach, ids, vectors in _blocks(b):
            if dim not in wave:
                continue
            numbers, own, queries, reach_q = wave[dim]
            step = max(1, CELLS // len(ids))
            for s in range(0, len(own), step):
                scores = _scores(queries[s : s + step], reach_q, vectors, reach)
                scores[own[s : s + step, None] == ids[None, :]] = -TOP - 1
                yield numbers[s : s + step], ids, scores


def _histograms(batches, wave, state) -> Iterator[pa.RecordBatch]:
    """Counts of scores by bin of each query's range.

    Bins below the one where this task alone reaches the wanted number hold no wanted value, as the kth value of
    all tasks is at least the kth of one; their counts are left out.
    """
    low, high, width, need = state
    counts = np.zeros((len(low), BINS), np.int64)
    for numbers, _, scores in _scored(batches, wave):
        lo, hi = low[numbers][:, None], high[numbers][:, None]
        inside = (scores >= lo) & (scores <= hi) & (scores > -TOP - 1) & (need[numbers][:, None] > 0)
        row, col = np.nonzero(inside)
        at = numbers[row]
        bins = ((scores[row, col].astype(np.uint64) - low[at].astype(np.uint64)) // width[at]).astype(np.int64)
        np.add.at(counts, (at, bins), 1)
    above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
    q, bins = np.nonzero((counts > 0) & (above < need[:, None]))
    if len(q):
        yield batch(COUNTS, q.astype(np.int32), bins, need[q], counts[q, bins])


def _winners(batches, wave, kth, need, query_ids, k) -> Iterator[pa.RecordBatch]:
    """All rows above a query's kth value, and of those equal to it the wanted number with the smallest ids."""
    ties: dict[int, np.ndarray] = {}
    for numbers, ids, scores in _scored(batches, wave):
        limit = kth[numbers][:, None]
        row, col = np.nonzero((scores > limit) & (scores > -TOP - 1))
        if len(row):
            yield batch(FOUND, query_ids[numbers[row]], ids[col], scores[row, col])
        row, col = np.nonzero((scores == limit) & (scores > -TOP - 1))
        for q in np.unique(row):
            own = np.concatenate([ties.get(numbers[q], ids[:0]), ids[col[row == q]]])
            ties[numbers[q]] = np.sort(own)[: need[numbers[q]]]
    for q, ids in ties.items():
        yield batch(FOUND, [int(query_ids[q])] * len(ids), ids, [int(kth[q])] * len(ids))


def _locate(blocks: DataFrame, wave_bc, low, high, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The kth score of every query, and how many of the rows equal to it belong to the k."""
    need = np.full(len(low), k, np.int64)
    kth = np.full(len(low), -TOP - 1, np.int64)  # fewer than k candidates: all of them
    open_ = np.ones(len(low), bool)
    while open_.any():
        span = high.astype(np.uint64) - low.astype(np.uint64)
        width = span // np.uint64(BINS) + np.uint64(1)
        state = blocks.sparkSession.sparkContext.broadcast((low, high, width, np.where(open_, need, 0)))
        counts = blocks.mapInArrow(lambda it: _histograms(it, wave_bc.value, state.value), _ddl(COUNTS))
        over = Window.partitionBy("q").orderBy(F.desc("bin"))
        hit = (
            counts.groupBy("q", "bin", "need").agg(F.sum("n").alias("n"))
            .withColumn("reached", F.sum("n").over(over))
            .where("reached >= need AND reached - n < need")  # one row per query of the wave
            .select("q", "bin", (F.col("need") - F.col("reached") + F.col("n")).alias("left"))
            .toPandas()
        )
        state.unpersist()
        found = np.zeros(len(low), bool)
        q, bins = hit["q"].to_numpy(np.int64), hit["bin"].to_numpy(np.uint64)
        found[q] = True
        need[q] = hit["left"].to_numpy(np.int64)
        first = (low[q].astype(np.uint64) + bins * width[q]).astype(np.int64)
        last = np.minimum(high[q].astype(object), first.astype(object) + width[q].astype(object) - 1).astype(np.int64) if len(q) else first
        low[q], high[q] = first, last
        open_ &= found
        done = open_ & (low == high)
        kth[done] = low[done]
        open_ &= ~done
    return kth, need


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Each query's k highest integer inner products: query_id, rank (from 1), vec_id, score.

    Components become floor(scale * x).  Candidates are all rows but those with the query's own key; ties go to the
    smaller key.  All scores are computed in blocks; tasks send histograms of them, never pairs, until the kth value
    of each query is known; then rows above it, and the smallest ids at it, are kept.  Queries go to the tasks in
    waves of about 4096; there are as many waves as the queries need.

    Vectors that are null or hold null or non-finite components, and rows without key, take no part.  Vectors
    compete with vectors of the same length only; empty ones score 0.  A candidate row that occurs twice counts twice;
    of query rows with the same key the smallest vector asks.  Scores are whole numbers of any size;
    those beyond the range of long stay at its end, and are ties there.
    Fewer than k candidates: all of them.  An empty table gives an empty result.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    finite = F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = vectors.where(F.col(key).isNotNull() & F.col(column).isNotNull())
    rows = usable.select(F.col(key).cast("long").alias("_id"), F.col(column).cast("array<double>").alias("_vec")).where(finite)
    asking = (
        usable.where(is_query).select(F.col(key).cast("long").alias("_id"), F.col(column).cast("array<double>").alias("_vec")).where(finite)
        .groupBy("_id").agg(F.min("_vec").alias("_vec"))
    )
    folder = new_folder(spark)
    blocks = spark.read.parquet(save_stage(rows.mapInArrow(lambda it: _pack(it, scale), _ddl(BLOCKS)), "blocks", folder))
    total = asking.count()
    waves = -(-total * 5 // (4 * WAVE))  # hashing deals out unevenly; a quarter is left for that
    asked = spark.read.parquet(
        save_stage(asking.withColumn("wave", F.pmod(F.xxhash64("_id"), F.lit(max(1, waves)))), "queries", folder, ["wave"])
    ) if total else None
    norms = {r["dim"]: r["reach"] for r in blocks.groupBy("dim").agg(F.max("reach").alias("reach")).collect()} if total else {}
    for w in range(waves):
        part = asked.where(F.col("wave") == w).select("_id", "_vec").orderBy("_id").toPandas()  # one bounded wave
        if part.empty:
            continue
        ids = part["_id"].to_numpy(np.int64)
        dims = part["_vec"].map(len).to_numpy()
        wave, high = {}, np.zeros(len(ids), np.int64)
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            cells, reach = floored(np.array(part["_vec"].iloc[at].tolist(), np.float64).reshape(len(at), d), scale)
            wave[int(d)] = (at, ids[at], cells, reach)
            with np.errstate(over="ignore", invalid="ignore"):  # infinity, then the whole range of long
                most = np.abs(cells).sum(axis=1) * norms.get(int(d), 0.0) + 1 if np.isfinite(reach) else np.full(len(at), np.inf)
            high[at] = np.where(most < 2.0**62, most, 0).astype(np.int64) + np.where(most < 2.0**62, 0, TOP)
        wave_bc = spark.sparkContext.broadcast(wave)
        kth, need = _locate(blocks, wave_bc, -high, high.copy(), k)
        limits = spark.sparkContext.broadcast((kth, need, ids))
        found = blocks.mapInArrow(lambda it: _winners(it, wave_bc.value, *limits.value, k), _ddl(FOUND))
        over = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = found.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        save_stage(best, f"found/wave={w}", folder)
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(f"{folder}/found").select("query_id", "rank", "vec_id", "score")
