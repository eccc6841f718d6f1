"""Packing of tokenized documents into sequences by minimum bin slack."""

from __future__ import annotations

import math
import os
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import enter, parts, ship, utf8
from carelens.sources.staging import stage

CACHED = 400_000  # words a worker remembers with their ids
CACHED_BYTES = 100 << 20  # they take at most, about
LONG = 1_000  # bytes of a word that is not remembered
BATCH = 256  # texts whose unknown words are encoded together
AT_ONCE = 2_000  # words encoded as one text
SIGNS = b",."
CHECK_SPAN = np.dtype("<u4")

PIECES = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Known(dict):
    """Words a worker remembers with their ids, and about how many bytes they take."""

    size = 0


_known: dict[str, _Known] = {}


def words_of(text: bytes) -> list[bytes]:
    """Parts of a text whose ids, one after the other, are the ids of the text.

    The tokenizer drops white space and lets no token span it.  It lower-cases, so A-Z can be lower-cased first, which
    leaves fewer different words.  Texts that may hold a special token keep their letters.
    """
    return (text if b"<|" in text else text.lower()).split()


def _encode_words(words: list[bytes], path: str) -> Iterator[bytes]:
    """Ids of each word, from one text of them all: a token belongs to the word in which it starts."""
    for s in range(0, len(words), AT_ONCE):
        part = [w.decode() for w in words[s : s + AT_ONCE]]
        found = _tokenizer(path).encode(" ".join(part), add_special_tokens=False)
        ids = np.array(found.ids, CHECK_SPAN).tobytes()
        starts = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids) // 4)
        first = np.cumsum([0, *(len(w) + 1 for w in part[:-1])])
        cuts = (4 * np.searchsorted(starts, first)).tolist() + [len(ids)]
        yield from (ids[a:b] for a, b in zip(cuts, cuts[1:]))


def _encode_new(words: Iterable[bytes], known: dict[bytes, bytes], path: str) -> dict[bytes, bytes]:
    """Ids of words not met before.

    The tokenizer cuts letters from signs, so a comma or point after a letter at a word's end is a token of its own; and a
    run of a-z is one piece for it, which its model takes as it stands.  Other words are encoded as text.
    """
    out: dict[bytes, bytes] = {}
    stems: dict[bytes, bytes | None] = {}
    for w in words:
        stem = w[:-1] if w[-1] in SIGNS and w[-2:-1].isalpha() and b"<|" not in w else w
        out[w] = stem
        stems[stem] = known.get(stem)
        if stem is not w:
            stems[w[-1:]] = known.get(w[-1:])
    model, rest = _tokenizer(path).model, []
    for w, ids in stems.items():
        if ids is None:
            if w.isalpha() and w.islower():
                stems[w] = array("I", [t.id for t in model.tokenize(w.decode())]).tobytes()
            else:
                rest.append(w)
    stems.update(zip(rest, _encode_words(rest, path)))
    return {w: stems[stem] if stem is w else stems[stem] + stems[w[-1:]] for w, stem in out.items()}


def encode(texts: pa.Array, path: str, end: int) -> Iterator[bytes]:
    """Ids of each text and the end id, as little-endian 32-bit numbers."""
    enter("packing", _known.clear)
    known, last = _known.setdefault(path, _Known()), np.array([end], CHECK_SPAN).tobytes()
    for part in parts(pa.RecordBatch.from_arrays([texts], ["text"]), 0, BATCH):
        if len(known) > CACHED or known.size > CACHED_BYTES:  # words met first are the common ones
            early = dict(islice(known.items(), len(known) // 2))
            known.clear()
            known.update(early)
            known.size //= 2
        found, new = [], {}
        for text in utf8(part.column(0)):
            words = words_of(text)
            ids = list(map(known.get, words))
            gaps = [(i, words[i]) for i, x in enumerate(ids) if x is None] if None in ids else []
            new.update(dict.fromkeys(w for _, w in gaps))
            found.append((ids, gaps))
        learnt = _encode_new(new, known, path)
        for ids, gaps in found:
            for i, w in gaps:
                ids[i] = learnt[w]
            yield b"".join(ids) + last
        short = {w: x for w, x in learnt.items() if len(w) <= LONG}
        known.update(short)
        known.size += sum(len(w) + len(x) for w, x in short.items()) + 200 * len(short)


def _cut(batches: Iterator[pa.RecordBatch], path: str, end: int, size: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    step = 4 * size
    for b in (part for whole in batches for part in parts(whole, 1, 4 * BATCH)):
        at, rows = [], []
        for i, ids in enumerate(encode(b.column(1), path, end)):
            for piece, s in enumerate(range(0, len(ids), step)):
                own = ids[s : s + step]
                at.append(i)
                rows.append((piece, s // 4, len(own) // 4, zlib.crc32(own), own if with_ids else None))
        columns = [pa.array(c, t) for c, (_, t) in zip(zip(*rows), PIECES)] if rows else [pa.array([], t) for _, t in PIECES]
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *columns], ["_key", *(n for n, _ in PIECES)])


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths that fills ``room`` best: subset sums as the bits of a number.

    Lengths come from the largest down, each as often as it is there and fits; the search ends when the room is full.
    """
    reach, steps, within = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            k = min(k, left)
            steps.append((reach, length, k))
            reach |= (reach << (length * k)) & within
            left -= k
            k *= 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for before, length, k in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + k
            total -= length * k
    return taken


def plan(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (lengths of a bin) and how many bins have each.

    A bin begins with the largest length left and takes the fullest combination of the others; it is repeated as
    long as its lengths last, so each pattern uses up a length: there are at most ``size`` patterns for any input.
    """
    left, out = dict(counts), []
    while left:
        first = max(left)
        left[first] -= 1
        pattern = fullest({x: n for x, n in left.items() if n}, size - first)
        left[first] += 1
        pattern[first] = pattern.get(first, 0) + 1
        bins = min(left[x] // n for x, n in pattern.items())
        out.append((pattern, bins))
        for x, n in pattern.items():
            left[x] -= n * bins
            if not left[x]:
                del left[x]
    return out


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """By length: first rank, copies in a bin, first bin and offset of each run of pieces, by rank."""
    runs: dict[int, list] = {}
    used: dict[int, int] = {}
    base = 0
    for pattern, bins in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            copies = pattern[length]
            runs.setdefault(length, []).append((used.get(length, 0), copies, base, offset))
            used[length] = used.get(length, 0) + copies * bins
            offset += copies * length
        base += bins
    return {x: np.array(r, np.int64) for x, r in runs.items()}


def _place(batches: Iterator[pa.RecordBatch], by_length: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The sequence and offset of each piece, from its length and its rank among pieces of that length."""
    for b in batches:
        length = b.column("length").to_numpy(zero_copy_only=False)
        rank = b.column("_rank").to_numpy(zero_copy_only=False)
        sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for x in np.unique(length):
            at, runs = np.flatnonzero(length == x), by_length[int(x)]
            first, copies, base, start = runs[np.searchsorted(runs[:, 0], rank[at], side="right") - 1].T
            sequence[at] = base + (rank[at] - first) // copies
            offset[at] = start + (rank[at] - first) % copies * x
        kept = b.drop_columns(["_rank"])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence), pa.array(offset)], [*kept.schema.names, "sequence_id", "offset"])


def cut_pieces(docs: DataFrame, size: int = 4096, tokenizer: str | None = None, end: int = 1, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``size`` ids of each document: key, piece, start, length, ids_crc32, and the ids if asked for."""
    ship(docs.sparkSession)
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    cut = rows.mapInArrow(
        lambda it: _cut(it, path, end, size, with_ids), f"_key {kind}, piece int, start long, length long, ids_crc32 long, ids binary"
    )
    return cut if with_ids else cut.drop("ids")


def pack(docs: DataFrame, size: int = 4096, tokenizer: str | None = None, end: int = 1, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Place all documents in sequences of at most ``size`` tokens: one row per piece.

    Columns: the key, piece (from 0), start (ids of the document before it), length, ids_crc32, ``ids`` if asked
    for, sequence_id (from 0) and offset, gapless from 0 in each sequence.  A document is its ids and the end id; only
    documents longer than a sequence are cut, and only their last piece may be shorter.

    Bins are planned from the number of pieces of each length, a table of ``size`` rows for any input, which is all
    the driver sees.  Pieces of a length are then numbered in slices, and a number means a place; a length that a
    third of all pieces has is spread over about as many slices as the root of the number of pieces.

    A missing or empty text is the end id alone.  A missing key stays; rows that repeat are packed each; an empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = stage(cut_pieces(docs, size, tokenizer, end, key, text, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row per length
    by_length = spark.sparkContext.broadcast(slots(plan(counts, size)))
    slices = max(1, math.isqrt(sum(counts.values())))
    sliced = pieces.withColumn("_slice", F.pmod(F.xxhash64("_key", "piece"), F.lit(slices)).cast("int"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("length", "_slice").agg(F.count("*").alias("_n"))
        .select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("length", "_slice").orderBy("_key", "piece", "start", "ids_crc32")
    ranked = (
        sliced.withColumn("_row", F.row_number().over(within)).join(starts, ["length", "_slice"])
        .withColumn("_rank", F.col("_before") + F.col("_row") - 1)
    )
    columns = ["_key", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = ", ".join(f"{n} {t}" for n, t in pieces.select(columns).dtypes)
    placed = ranked.select(*columns, "_rank").mapInArrow(lambda it: _place(it, by_length.value), f"{schema}, sequence_id long, offset long")
    return placed.withColumnRenamed("_key", key)
