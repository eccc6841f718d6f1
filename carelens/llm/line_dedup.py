"""Lines that several documents share: kept in the first of them only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import parts, ship, utf8
from carelens.sources.staging import stage

LEAST_DOCS = 2
LEAST_CHARS = 10


def line_key(line: bytes) -> bytes:
    """Space at both ends cut off, A-Z lower-cased; both as bytes have it: ASCII only."""
    return line.strip().lower()


def _long_enough(key: bytes, chars: int) -> bool:
    return len(key) >= chars and (len(key) >= 4 * chars or len(key.decode()) >= chars)


def _explode(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.RecordBatch]:
    """Row, place and hash of every line that is long enough."""
    names = ["_key", "_print", "pos", "hash"]
    for b in (part for whole in batches for part in parts(whole, 2, rows=4096)):
        at, places, hashes = [], [], []
        for i, text in enumerate(utf8(b.column(2))):
            for pos, line in enumerate(text.split(b"\n")):
                own = line_key(line)
                if _long_enough(own, chars):
                    at.append(i), places.append(pos), hashes.append(xxhash.xxh3_128_digest(own))
        rows = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(places, pa.int32()), pa.array(hashes, pa.binary())], names)


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines before and dropped, and the text of the others."""
    for b in (part for whole in batches for part in parts(whole, 1)):
        n, dropped, kept = [], [], []
        for text, gone in zip(utf8(b.column(1)), b.column(2).to_pylist()):
            lines = text.split(b"\n")
            n.append(len(lines)), dropped.append(len(gone or ()))
            if gone:
                out = set(gone)
                text = b"\n".join(line for i, line in enumerate(lines) if i not in out)
            kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary())], ["_key", "n_lines", "n_dropped", "kept"]
        )


def drop_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """Per row: the key, n_lines, n_dropped and ``kept``, the text without lines that other documents have before it.

    A line's key is the line without white space at its ends, A-Z lower-cased.  Keys of at least ``least_chars`` code points
    in at least ``least_docs`` documents stay in the document with the smallest id only, there as often as they stand.
    Other lines stay as they are, joined by line feeds; of a text without other lines an empty one is left.

    Lines are hashed to 128 bits where they stand; only hashes, ids and places are shuffled and counted.  A hash of very
    many lines is combined in each task before it moves, and the join with repeated hashes can be split.  Texts move
    once, to meet the places that go.

    A missing or empty text is one empty line.  Rows of one id are one document; all rows without id are one document
    that comes after all others.  Repeated rows give repeated rows, an empty table an empty result; other columns are
    ignored.
    """
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(body).alias("_print"), body.alias("_text"))
    lines = stage(rows.mapInArrow(lambda it: _explode(it, least_chars), f"_key {kind}, _print long, pos int, hash binary"), "lines")
    held = lines.groupBy("hash", "_key").agg(F.lit(1).alias("one"))
    repeated = held.groupBy("hash").agg(F.count("*").alias("docs"), F.min("_key").alias("keeper")).where(F.col("docs") >= least_docs)
    gone = (
        lines.join(stage(repeated, "repeated"), "hash").where(~F.col("_key").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("_key").alias("_of"), F.col("_print").alias("_with")).agg(F.collect_set("pos").alias("_gone"))
    )
    both = rows.join(stage(gone, "gone"), F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_print") == F.col("_with")), "left")
    done = both.select("_key", "_text", "_gone").mapInArrow(_put_together, f"_key {kind}, n_lines long, n_dropped long, kept binary")
    return done.select(F.col("_key").alias(key), "n_lines", "n_dropped", F.col("kept").cast("string").alias("kept"))
