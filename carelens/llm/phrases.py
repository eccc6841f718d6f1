"""Phrases that stand together more often than their parts: set-oriented mining of occurrence relations."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import parts, ship, small_batches, utf8
from carelens.sources.staging import new_folder, stage

LONGEST = 3  # words of a phrase
LEAST = 10  # occurrences of a candidate
INSIDE = 50  # per cent of its occurrences inside a longer candidate that drop a phrase
TOP = 2_000  # phrases of a language
UNKNOWN = "und"
BLOCK = 1 << 20  # bytes of text whose words share a dictionary
HELD = 4  # blocks' worth of text in unfinished blocks
RUN = 1 << 17  # words of a piece worked on at once
ROW_GROUP = 2  # blocks that are written, and read, at once
SHARES = 64  # of a language, that are ranked apart first
FILTER_BITS = (1 << 27) - 39  # of the broadcast filter of frequent groups: 16 MB
SEED = 0  # of the 64-bit hashes

WORD = re.compile(rb"[^ \t]+")
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)  # cases; ends of pieces
RELATION = pa.schema([("lang", pa.string()), ("at", pa.binary()), ("own", pa.binary()), ("codes", pa.binary()), ("names", pa.binary())])
RELATION_DDL = "lang string, at binary, own binary, codes binary, names binary"


def runs(piece: bytes, ahead: int) -> Iterator[tuple[list[bytes], int]]:
    """Words of a piece and how many are its own; a very long one comes in runs, each with ``ahead`` words of the next."""
    if len(piece) <= BLOCK:
        words = piece.split()  # of bytes: spaces and tabs, the other white space ends pieces
        if words:
            yield words, len(words)
        return
    found = (m[0] for m in WORD.finditer(piece))
    many = max(RUN, ahead)
    head = list(islice(found, many))
    while head:
        following = list(islice(found, many))
        yield head + following[:ahead], len(head)
        head = following


class _Block:
    """Occurrences of the words of one language, in the order of pieces and places; pieces are a place apart."""

    def __init__(self, lang: str):
        self.lang, self.codes, self.lengths, self.owned, self.known, self.size = lang, [], [], [], {}, 0

    def add(self, words: list[bytes], own: int, size: int) -> None:
        known = self.known
        self.codes += [known.setdefault(w, len(known)) for w in words]
        self.lengths.append(len(words)), self.owned.append(own)
        self.size += size

    def row(self) -> pa.RecordBatch:
        lengths = np.array(self.lengths, np.int64)
        start = np.cumsum(lengths) - lengths
        within = np.arange(len(self.codes)) - np.repeat(start, lengths)
        own = within < np.repeat(np.array(self.owned), lengths)
        steps = np.where(within == 0, 2, 1).astype(np.uint8)  # from one place to the next
        values = [self.lang], [steps.tobytes()], [np.packbits(own).tobytes()], [np.array(self.codes, "<i4").tobytes()], [b"\n".join(self.known)]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, RELATION)], schema=RELATION)


def _occurrences(batches: Iterator[pa.RecordBatch], ahead: int) -> Iterator[pa.RecordBatch]:
    """The first relation: a row per block, words by their number in the block's own dictionary."""
    blocks: dict[str, _Block] = {}
    for b in (part for whole in batches for part in parts(whole, 1)):
        for lang, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
            for piece in text.translate(FOLD).split(b"\n"):
                for words, own in runs(piece, ahead):
                    if lang not in blocks:
                        blocks[lang] = _Block(lang)
                    blocks[lang].add(words, own, min(len(piece), BLOCK))
                    if blocks[lang].size >= BLOCK:
                        yield blocks.pop(lang).row()
        if sum(x.size for x in blocks.values()) >= HELD * BLOCK:  # many languages
            yield from (blocks.pop(x).row() for x in list(blocks))
    yield from (x.row() for x in blocks.values())


def word_hash(word: bytes, lang: str, seed: int = SEED) -> int:
    return xxhash.xxh3_64_intdigest(word + b"\n" + lang.encode(), seed) - (1 << 63)


def _unpack(row: dict, k: int, seed: int):
    """Places, whether they are the block's own, numbers of groups, and the word hashes of each group (a column a word)."""
    at = np.cumsum(np.frombuffer(row["at"], np.uint8), dtype=np.int64) if k == 1 else np.cumsum(np.frombuffer(row["at"], "<u4"), dtype=np.int64)
    codes = np.frombuffer(row["codes"], "<i4")
    own = np.unpackbits(np.frombuffer(row["own"], np.uint8), count=len(codes)).astype(bool)
    if k > 1:
        return at, own, codes, np.frombuffer(row["names"], "<i8").reshape(-1, k)
    words = row["names"].split(b"\n")
    return at, own, codes, np.fromiter((word_hash(w, row["lang"], seed) for w in words), np.int64, len(words)).reshape(-1, 1)


def _rotated(h: np.ndarray, by: int) -> np.ndarray:
    u = h.astype(np.uint64)
    return (u << np.uint64(by) | u >> np.uint64(64 - by)).astype(np.int64) if by else h


def _bits(groups: np.ndarray) -> np.ndarray:
    """The filter's bit of each group, as ``_bit`` has it."""
    x = groups[:, 0].copy()
    for i in range(1, groups.shape[1]):
        x ^= _rotated(groups[:, i], 17 * i % 63)
    return np.mod(x, FILTER_BITS)


def _bit(k: int) -> Column:
    x = F.col("h1")
    for i in range(1, k):
        by, h = 17 * i % 63, F.col(f"h{i + 1}")
        x = x.bitwiseXOR(F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by)))
    return F.pmod(x, F.lit(FILTER_BITS))


def filter_of(frequent: DataFrame, k: int) -> np.ndarray:
    """A filter of fixed size that every frequent group passes, and few others: a bit for each."""
    bits = frequent.select(_bit(k).alias("bit")).groupBy(F.floor(F.col("bit") / 32768).alias("part")).agg(F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits"))
    out = np.zeros(-(-FILTER_BITS // 32768) * 4096, np.uint8)
    for r in bits.collect():  # 4,096 rows of 4 kB at most
        out[r["part"] * 4096 : (r["part"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _semi(groups: np.ndarray, codes: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Which occurrences have a frequent group."""
    at = _bits(groups)
    return (allowed[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)[codes]


def _extend(at: np.ndarray, own: np.ndarray, codes: np.ndarray, groups: np.ndarray):
    """The relation merged with itself at the next place: groups one word longer, in the same order."""
    first = np.flatnonzero(at[1:] == at[:-1] + 1)
    pairs = codes[first].astype(np.int64) * len(groups) + codes[first + 1]
    found, numbers = np.unique(pairs, return_inverse=True)
    longer = np.column_stack([groups[found // max(len(groups), 1)], groups[found % max(len(groups), 1), -1]])
    return at[first], own[first], numbers.astype(np.int32), longer


def _joined(batches: Iterator[pa.RecordBatch], k: int, seed: int, allowed: np.ndarray):
    """Relation k less its rare groups, merged at adjacent places, block by block."""
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1).to_pylist()[0]
            at, own, codes, groups = _unpack(row, k, seed)
            kept = _semi(groups, codes, allowed)
            yield row["lang"], *_extend(at[kept], own[kept], codes[kept], groups)


def _count_words(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1).to_pylist()[0]
            _, own, codes, groups = _unpack(row, 1, seed)
            n = np.bincount(codes[own], minlength=len(groups))
            words = pa.array(row["names"].split(b"\n"), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(groups[:, 0]), pa.array([row["lang"]] * len(n), pa.string()), words, pa.array(n, pa.int64())], ["h1", "lang", "word", "n"])


def _count_groups(batches: Iterator[pa.RecordBatch], k: int, seed: int, allowed: np.ndarray) -> Iterator[pa.RecordBatch]:
    for _, _, own, codes, groups in _joined(batches, k, seed, allowed):
        n = np.bincount(codes[own], minlength=len(groups))
        names = [f"h{i + 1}" for i in range(k + 1)]
        yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(groups[:, i])) for i in range(k + 1)), pa.array(n, pa.int64())], [*names, "n"])


def _next_relation(batches: Iterator[pa.RecordBatch], k: int, seed: int, allowed: np.ndarray, longer: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Relation k + 1: occurrences of the groups that pass the filter of that length."""
    for lang, at, own, codes, groups in _joined(batches, k, seed, allowed):
        kept = _semi(groups, codes, longer)
        used, numbers = np.unique(codes[kept], return_inverse=True)
        values = [lang], [np.diff(at[kept], prepend=0).astype("<u4").tobytes()], [np.packbits(own[kept]).tobytes()], [numbers.astype("<i4").tobytes()], [groups[used].astype("<i8").tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, RELATION)], schema=RELATION)


def count_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text: str = "text", lang: str = "lang", seed: int = SEED
) -> tuple[DataFrame, dict[int, DataFrame]]:
    """Words of each language, n; and by length the phrases with at least ``least`` occurrences, f, by word hashes h1, h2 ...

    The table of length 1 has lang and word besides.  Counts are exact: a hash stands for one word of one language,
    which is checked.
    """
    spark = docs.sparkSession
    ship(spark)
    with small_batches(spark):
        return _counted(docs, longest, least, text, lang, seed)


def _counted(docs: DataFrame, longest: int, least: int, text: str, lang: str, seed: int) -> tuple[DataFrame, dict[int, DataFrame]]:
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    root = new_folder(spark)

    def kept(df: DataFrame, name: str, **how) -> DataFrame:
        df.write.options(compression="zstd", **how).parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    few = {"parquet.block.row.count.limit": ROW_GROUP}
    relation = kept(rows.mapInArrow(lambda it: _occurrences(it, longest - 1), RELATION_DDL), "words", **few)
    words = relation.select("lang", "own", "codes", "names", F.lit(b"").alias("at")).mapInArrow(
        lambda it: _count_words(it, seed), "h1 long, lang string, word binary, n long"
    )
    name = F.struct("lang", "word")
    counted = kept(words.groupBy("h1").agg(F.sum("n").alias("f"), F.min(name).alias("name"), F.max(name).alias("other")), "word_counts")
    if not counted.where("name <> other").isEmpty():
        raise ValueError("two words have one 64-bit hash: take another seed")
    totals = counted.groupBy("name.lang").agg(F.sum("f").alias("n"))
    frequent = {1: stage(counted.where(F.col("f") >= least).select("h1", "f", "name.lang", F.col("name.word").cast("string").alias("word")), "frequent")}
    allowed = spark.sparkContext.broadcast(filter_of(frequent[1], 1))
    for k in range(1, longest):
        keys = [f"h{i + 1}" for i in range(k + 1)]
        schema = ", ".join(f"{c} long" for c in keys)
        found = relation.mapInArrow(lambda it, k=k, a=allowed: _count_groups(it, k, seed, a.value), f"{schema}, n long")
        frequent[k + 1] = stage(found.groupBy(*keys).agg(F.sum("n").alias("f")).where(F.col("f") >= least), "frequent")
        if k + 1 < longest:
            longer = spark.sparkContext.broadcast(filter_of(frequent[k + 1], k + 1))
            relation = kept(relation.mapInArrow(lambda it, k=k, a=allowed, b=longer: _next_relation(it, k, seed, a.value, b.value), RELATION_DDL), f"groups{k + 1}", **few)
            allowed = longer
    return totals, frequent


def _scored(candidates: DataFrame, frequent: dict[int, DataFrame], m: int) -> DataFrame:
    """Candidates of m words with a, and l, r and score of their lowest-scoring cut."""
    out = candidates.withColumnRenamed("f", "a")
    for k in range(1, m):
        left = frequent[k].select(*[F.col(f"h{i + 1}") for i in range(k)], F.col("f").alias(f"l{k}"))
        right = frequent[m - k].select(*[F.col(f"h{i + 1}").alias(f"h{k + i + 1}") for i in range(m - k)], F.col("f").alias(f"r{k}"))
        out = out.join(left, [f"h{i + 1}" for i in range(k)]).join(right, [f"h{k + i + 1}" for i in range(m - k)])
    wide = {c: F.col(c).cast("decimal(16,0)") for c in ("a", *(f"{x}{k}" for k in range(1, m) for x in "lr"))}
    cuts = [
        F.struct(
            F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide["a"] * wide["a"]), wide[f"l{k}"] * wide[f"r{k}"]).alias("score"),
            F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
        )
        for k in range(1, m)
    ]
    return out.withColumn("cut", F.array_min(F.array(*cuts)))


def mine_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, top: int = TOP, text: str = "text", lang: str = "lang", seed: int = SEED
) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut into pieces at points, commas, semicolons, colons, exclamation and question marks
    and line ends; words are what spaces and tabs set apart.  n counts a language's words, a the occurrences of a phrase
    within pieces.  Phrases of 2 to ``longest`` words with a >= ``least`` are candidates.  A cut after k words gives l and r,
    the occurrences of both parts, and floor(1000000 a a / (l r)); the lowest counts, of equal ones the first.  A candidate
    is dropped when a longer one that has its words side by side occurs at least ``inside`` per cent as often; one word
    longer is enough to look at, as what is longer still occurs no more often.  Order: score, then a, both descending, then
    phrase by its bytes.

    Relational mining: the occurrences of all words are written, in the order of pieces and places; each round drops
    occurrences of rare groups (a filter of fixed size, which may let some rare ones through), merges the relation with
    itself at adjacent places, counts the longer groups, and writes their relation for the next round.  The counts
    decide, so what the filter lets through changes nothing.  Rows of blocks, not single occurrences, are stored, with
    a dictionary each; counts are combined in each task before they move.

    A missing text is empty; a missing language is ``und``; repeated rows count each time; an empty table gives an empty
    result; other columns are ignored.  Exact up to 10^16 occurrences of a phrase.
    """
    totals, frequent = count_phrases(docs, longest, least, text, lang, seed)
    out = None
    for m in range(2, longest + 1):
        found = frequent[m]
        if m < longest:
            within = None
            for o in (0, 1):
                own = frequent[m + 1].select(*[F.col(f"h{o + i + 1}").alias(f"h{i + 1}") for i in range(m)], F.col("f").alias("most"))
                within = own if within is None else within.union(own)
            keys = [f"h{i + 1}" for i in range(m)]
            within = within.groupBy(*keys).agg(F.max("most").alias("most"))
            found = found.join(within, keys, "left").where(F.col("most").isNull() | (100 * F.col("most") < inside * F.col("f"))).drop("most")
        scored = _scored(found, frequent, m).select(
            *[F.col(f"h{i + 1}") if i < m else F.lit(None).cast("long").alias(f"h{i + 1}") for i in range(longest)], "a", "cut.l", "cut.r", "cut.score"
        )
        out = scored if out is None else out.union(scored)
    for i in range(longest):
        names = frequent[1].select(F.col("h1").alias(f"h{i + 1}"), *([F.col("lang")] if i == 0 else []), F.col("word").alias(f"w{i + 1}"))
        out = out.join(names, f"h{i + 1}", "inner" if i < 2 else "left")
    out = out.withColumn("phrase", F.concat_ws(" ", *[F.col(f"w{i + 1}") for i in range(longest)]))
    # the first ones of every share of a language, then of the language: a share is a sixty-fourth, whatever the language
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    shared = out.select("lang", "phrase", "a", "l", "r", "score", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)).alias("share"))
    first = shared.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
