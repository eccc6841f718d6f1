"""Token counts of whole texts, by a broadcast table of frequent pre-tokens and caches in the workers."""

from __future__ import annotations

import heapq
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import batch, enter, parts, ship, utf8

FREQUENT = 65_536  # pre-tokens in the broadcast table
LONGEST = 64  # bytes of a pre-token in it: 4 MB of them at most
SUMMARY = 16_384  # of them that one task proposes
COUNTING = 131_072  # pre-tokens a task counts at once; beyond that the rare ones are forgotten
CACHED = 250_000  # pre-tokens a worker remembers besides
CACHED_BYTES = 32 << 20  # bytes of them

COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])
SPACE = "▁".encode()  # the library's own sign for a space
MIXED = re.compile(rb"\n[^ \n]*| ( *[^ \n]*)")


def pretokens(text: bytes) -> list[bytes]:
    """Pieces of a text whose token counts add up to the text's.

    The vocabulary has no piece with a space after another character, and none with a line feed, so no piece spans
    the start of a run of spaces or a line feed.  The text gets one leading space, as the library gives it.  A
    pre-token is a run of spaces, less the first one, and what follows; or a line feed and what follows.
    """
    if not text:
        return []
    if SPACE in text:
        text = text.replace(SPACE, b" ")
    if b"  " not in text and b" \n" not in text and text[0] not in b" \n" and text[-1] != 32:
        return text.replace(b"\n", b" \n").split(b" ")
    return [m[0] if m[0][0] == 10 else m[1] for m in MIXED.finditer(b" " + text)]


@cache
def _library(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model)


def pretoken_length(library, word: bytes) -> int:
    """Tokens of a pre-token; the library puts a space before it, which one after a line feed does not have."""
    if not word:
        return 1  # a single space
    return len(library.encode(word.decode())) - (word[0] == 10)


class _Lengths(dict):
    """Tier one is this table; what it lacks is looked up in, or encoded into, the worker's cache."""

    def __init__(self, frequent, library):
        super().__init__(frequent)
        self.library, self.rare, self.size = library, {}, 0

    def __missing__(self, word: bytes) -> int:
        n = self.rare.get(word)
        if n is None:
            n = pretoken_length(self.library, word)
            if len(word) > CACHED_BYTES:
                return n
            if len(self.rare) >= CACHED or self.size + len(word) > CACHED_BYTES:
                self.rare.clear()
                self.size = 0
            self.rare[word] = n
            self.size += len(word)
        return n


_tables: dict[str, _Lengths] = {}


def _table(token: str, packed, model: str) -> _Lengths:
    """The table of this query, kept by the worker from task to task."""
    enter("token_counts", _tables.clear)
    if token not in _tables:
        _tables.clear()
        blob, ends, lengths = packed
        starts = [0, *ends[:-1].tolist()]
        words = [blob[s:e] for s, e in zip(starts, ends.tolist())]
        _tables[token] = _Lengths(zip(words, lengths.tolist()), _library(model))
    return _tables[token]


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's most frequent pre-tokens of bounded length, by counts that forget rare ones when there are too many."""
    counts: Counter = Counter()
    for b in batches:
        for part in parts(b, 0):
            for text in utf8(part.column(0)):
                counts.update(w for w in pretokens(text) if len(w) <= LONGEST)
                if len(counts) > COUNTING:
                    counts = Counter(dict(heapq.nlargest(COUNTING // 4, counts.items(), key=lambda x: x[1])))
    top = heapq.nlargest(SUMMARY, ((n, w) for w, n in counts.items() if n > 1))
    if top:
        yield batch(COUNTS, [w for _, w in top], [n for n, _ in top])


def frequent_pretokens(texts: DataFrame, model: str) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Table of the most frequent pre-tokens of all texts: their bytes, ends and token counts."""
    proposed = texts.mapInArrow(_propose, "word binary, n long")
    top = proposed.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(FREQUENT).toPandas()
    words, library = [bytes(w) for w in top["word"]], _library(model)
    lengths = np.array([pretoken_length(library, w) for w in words], np.uint32)
    return b"".join(words), np.cumsum([len(w) for w in words], dtype=np.int64), lengths


def count_tokens(docs: DataFrame, model: str | None = None, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_bytes (UTF-8), n_tokens as the library counts the whole text, over_limit (n_tokens > limit).

    One pass over all texts proposes frequent pre-tokens of at most 64 bytes: each task sends its 16,384 most frequent at
    most, and the 65,536 most frequent of all become the broadcast table.  A second pass adds up the lengths of each text's
    pre-tokens from the table; others are encoded once by a worker and remembered.  What the table holds changes the
    speed only.  No pre-token of a document is shuffled.

    No begin or end token is counted; special strings inside texts are ordinary text, as by the library's default.
    A missing or empty text has 0 bytes and tokens; a missing key stays; repeated rows give repeated rows; an empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    model = model or public_tokenizers.path("piece_bpe_32k.model")
    kind = dict(docs.dtypes)[key]
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    packed = spark.sparkContext.broadcast(frequent_pretokens(texts, model))
    token = uuid.uuid4().hex

    def count(batches):
        lengths = _table(token, packed.value, model)
        get = lengths.__getitem__
        for b in (part for whole in batches for part in parts(whole, 1)):
            found = utf8(b.column(1))
            tokens = [sum(map(get, pretokens(t))) for t in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in found], pa.int64()), pa.array(tokens, pa.int64())], ["_key", "n_bytes", "n_tokens"]
            )

    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    counted = rows.mapInArrow(count, f"_key {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("_key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
