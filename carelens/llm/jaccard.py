"""Documents linked by the Jaccard similarity of their word shingles: a grouped prefix join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import batch, enter, most_frequent, parts, ship, utf8
from carelens.llm.components import components
from carelens.sources.staging import new_folder, save_stage, stage

SIZE = 5  # words of a shingle
PERCENT = 80  # least similarity
CHUNK = 8 << 20  # bytes of text worked on at once
STRETCH = 1 << 20  # bytes of text hashed at once
WORDS = 20_000  # words hashed at once of a longer text
BASE = 0x9E3779B97F4A7C15  # of the running sum, odd
LOCAL = 2  # sets of one task that make a shingle worth counting
COMMON = 4  # such sets of all tasks that make it a common one
MOST_COMMON = 1 << 20  # shingles in the broadcast order, 16 MB; others come by hash alone
FILTER_BITS = (1 << 26) - 5  # of the broadcast filter of documents whose sets are wanted: 8 MB
SKETCH_BITS = 2_048  # of a set's sketch, a power of two
SALT = 2_000  # sets compared with one centre in a task

READ = pa.schema([("common", pa.bool_()), ("doc_id", pa.int64()), ("n", pa.int32()), ("set_id", pa.binary()), ("hash", pa.int64()), ("times", pa.int64())])
POSTINGS = pa.schema([("kind", pa.int32()), ("hash", pa.int64()), ("gid", pa.int64()), ("place", pa.int64()), ("doc", pa.int64()), ("set_id", pa.binary())])
SETS = pa.schema([("v", pa.int64()), ("cells", pa.binary())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    up, down = np.full(STRETCH, BASE, np.uint64), np.full(STRETCH, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _summed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A running sum over the bytes of the words, spaces between them; starts and ends of the words."""
    cells = np.frombuffer(b" ".join(words), np.uint8)
    sums = np.zeros(len(cells) + 1, np.uint64)
    np.cumsum((cells.astype(np.uint64) + np.uint64(1)) * _powers()[0][: len(cells)], out=sums[1:])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    return sums, ends - lengths, ends


def _long_word(word: bytes) -> tuple[int, int]:
    """Sum over the bytes of a word of any length, and the power of the base behind it."""
    up, total = _powers()[0], 0
    for s in range(0, len(word), STRETCH):
        part = np.frombuffer(word, np.uint8, min(STRETCH, len(word) - s), s).astype(np.uint64) + np.uint64(1)
        total += int((part * up[: len(part)]).sum(dtype=np.uint64)) * pow(BASE, s, 1 << 64)
    return total % (1 << 64), pow(BASE, len(word), 1 << 64)


def _long_runs(words: list[bytes]) -> np.ndarray:
    """The hashes of ``_runs``, put together from sums of single words, a bounded number of bytes at a time."""
    up, down = _powers()
    own, powers = np.empty(len(words), np.uint64), np.empty(len(words), np.uint64)
    first = size = 0
    for i, w in enumerate([*words, None]):
        if first < i and (w is None or size + len(w) >= STRETCH):
            sums, starts, ends = _summed(words[first:i])
            own[first:i], powers[first:i] = (sums[ends] - sums[starts]) * down[starts], up[ends - starts]
            first, size = i, 0
        if w is not None and len(w) >= STRETCH:
            own[i], powers[i] = _long_word(w)
            first = i + 1
        elif w is not None:
            size += len(w) + 1
    k = min(SIZE, len(words))
    n = len(words) - k + 1
    total = own[k - 1 :]
    for j in range(k - 2, -1, -1):  # a word, a space, what follows
        total = own[j : j + n] + powers[j : j + n] * (np.uint64(ord(" ") + 1) + np.uint64(BASE) * total)
    return _mix(total)


def _runs(words: list[bytes]) -> np.ndarray:
    """Hashes of all runs of five words, from one running sum over the bytes of the text; the same ones for every length."""
    if sum(map(len, words)) + len(words) - 1 > STRETCH:
        return _long_runs(words)
    sums, starts, ends = _summed(words)
    k = min(SIZE, len(words))
    first = starts[: len(words) - k + 1]
    return _mix((sums[ends[k - 1 :]] - sums[first]) * _powers()[1][first])


def shingles(text: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of all words as one where there are fewer than five."""
    words = text.lower().split()  # of bytes: A-Z only, and the six white space characters
    if not words:
        return np.empty(0, np.uint64)
    if len(text) < STRETCH:
        return np.unique(_runs(words))
    parts = [_runs(words[i : i + WORDS + SIZE - 1]) for i in range(0, max(1, len(words) - SIZE + 1), WORDS)]
    return np.unique(np.concatenate(parts))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and sets, a bounded number of bytes at a time."""
    enter("jaccard")
    for b in (part for whole in batches for part in parts(whole, 1, size=CHUNK)):
        ids, texts = b.column(0).to_pylist(), utf8(b.column(1))
        first = size = 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= CHUNK or i == len(texts) - 1:
                yield ids[first : i + 1], [shingles(x) for x in texts[first : i + 1]]
                first, size = i + 1, 0


def _set_id(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and id of every set, and the shingles that several of this task's sets have."""
    hashes, times = np.empty(0, np.uint64), np.empty(0, np.int64)
    for ids, sets in _sets(batches):
        names = [_set_id(s) if len(s) else None for s in sets]
        m = len(ids)
        yield batch(READ, [False] * m, ids, [len(s) for s in sets], names, pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()))
        distinct = list({n: s for n, s in zip(names, sets) if n}.values())
        if distinct:
            found, n = np.unique(np.concatenate(distinct), return_counts=True)
            hashes, at = np.unique(np.concatenate([hashes, found[n > 1]]), return_inverse=True)
            times = np.bincount(at, np.concatenate([times, n[n > 1]]), len(hashes)).astype(np.int64)
            if len(hashes) > 2 * MOST_COMMON:
                top = np.argpartition(times, -MOST_COMMON)[-MOST_COMMON:]
                top.sort()
                hashes, times = hashes[top], times[top]
    keep = times >= LOCAL
    if m := int(keep.sum()):
        yield batch(READ, [True] * m, pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), hashes[keep].astype(np.int64), times[keep])


def _common(read: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the commonest shingles, sorted, and their ranks from the rarest of them (1) up."""
    counts = stage(read.where("common").groupBy("hash").agg(F.sum("times").alias("times")).where(F.col("times") >= COMMON), "common")
    top = most_frequent(counts, "times", MOST_COMMON).toPandas()
    hashes, times = top["hash"].to_numpy(np.int64).astype(np.uint64), top["times"].to_numpy(np.int64)
    ranks = np.empty(len(hashes), np.int64)
    ranks[np.lexsort((hashes, times))] = np.arange(1, len(hashes) + 1)
    order = np.argsort(hashes)
    return hashes[order], ranks[order]


def prefix(own: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles of a set in the order of all sets: common ones last, by how common; others by hash.

    Two sets that are similar enough share one of the first n - ceil(0.8 n) + 1 in any order all sets agree on.
    """
    hashes, ranks = common
    n = len(own)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
        rank = np.where(hashes[at] == own, ranks[at], 0)
        own = own[np.lexsort((own, rank))]
    return own[: n - -(-n * PERCENT // 100) + 1]


def order_of(shingle: np.uint64, common: tuple[np.ndarray, np.ndarray]) -> int:
    """Where a shingle stands in the order of all sets, as a number; shingles that share their first 42 bits may get one number."""
    hashes, ranks = common
    at = int(np.searchsorted(hashes, shingle))
    rank = int(ranks[at]) if at < len(hashes) and hashes[at] == shingle else 0
    return rank << 42 | int(shingle) >> 22


def _post(batches: Iterator[pa.RecordBatch], common) -> Iterator[pa.RecordBatch]:
    """A row per prefix shingle of each group (kind 0) with a document of it, and a row per distinct set with its group and where the prefix ends (kind 1)."""
    seen: set[bytes] = set()
    for ids, sets in _sets(batches):
        hashes, gids, places, docs, members, owners, sizes, ends = [], [], [], [], [], [], [], []
        for doc, own in zip(ids, sets):
            if not len(own) or (name := _set_id(own)) in seen:
                continue
            seen.add(name)
            first = prefix(own, common)
            gid = xxhash.xxh3_64_intdigest(first.tobytes(), seed=len(own)) & (2**63 - 1)
            hashes.append(first)
            gids.append(np.full(len(first), gid, np.int64))
            places.append((np.int64(len(own)) << np.int64(32)) + np.arange(len(first), dtype=np.int64))
            docs.append(np.full(len(first), doc, np.int64))
            members.append(name), owners.append(gid), sizes.append(len(own) << 32), ends.append(order_of(first[-1], common))
        if hashes:
            h = np.concatenate(hashes).astype(np.int64)
            m = len(h)
            yield batch(POSTINGS, np.zeros(m, np.int32), h, np.concatenate(gids), np.concatenate(places), np.concatenate(docs), pa.nulls(m, pa.binary()))
            yield batch(POSTINGS, np.ones(len(members), np.int32), ends, owners, sizes, pa.nulls(len(members), pa.int64()), members)


def sketch(own: np.ndarray) -> np.ndarray:
    """Size of a set, and for each place of a hash whether an odd number of its shingles fall there."""
    odd = np.bincount((own >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.concatenate([np.array([len(own)], np.uint64), np.packbits(odd.astype(np.uint8)).view(np.uint64)])


def _wanted(batches: Iterator[pa.RecordBatch], bits: np.ndarray, form) -> Iterator[pa.RecordBatch]:
    """Sets, in some form, of the documents that pass the filter (and of a few others)."""
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        at = np.mod(ids, FILTER_BITS)
        keep = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
        for own, sets in _sets([b.take(pa.array(keep))]) if len(keep) else ():
            yield batch(SETS, own, [form(s).tobytes() for s in sets])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def may_be_similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether sets with these sketches can be similar: places in which sketches differ hold a shingle that only one set has."""
    apart = int(np.bitwise_count(a[1:] ^ b[1:]).sum(dtype=np.int64))
    return (100 + PERCENT) * apart <= (100 - PERCENT) * int(a[0] + b[0])


def _compare(batches: Iterator[pa.RecordBatch], alike) -> Iterator[pa.RecordBatch]:
    """Each centre's set comes first; those that follow are compared with it."""
    at, centres = None, []
    enter("jaccard")
    for b in (part for whole in batches for part in parts(whole, 4, rows=1024, size=CHUNK)):
        found = []
        for centre, salt, member, v, cells in zip(*(c.to_pylist() for c in b.columns)):
            own = np.frombuffer(cells, np.uint64)
            if not member:
                if at != (centre, salt):
                    at, centres = (centre, salt), []
                centres.append(own)
            elif any(alike(own, c) for c in centres):
                found.append((v, centre))
        if found:
            yield batch(LINKS, *zip(*found))


def verify(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of documents whose sets are similar; ``texts`` has _key and _text.

    Small sketches are compared first, which lose no similar pair; whole sets move for the pairs that are left only.
    """
    likely = _alike(texts, stage(pairs, "pairs"), sketch, may_be_similar)
    return _alike(texts, likely, np.asarray, similar)


def _alike(texts: DataFrame, pairs: DataFrame, form, alike) -> DataFrame:
    """Those of the written pairs (a, b) of documents whose sets, in this form, are alike.

    Sets are computed again from the texts of the documents in question, which a filter of fixed size finds; each set
    goes to the centres (b) it is compared with.  A centre with very many sets is copied to several tasks.
    """
    spark = texts.sparkSession
    bit = F.pmod(F.col("v"), F.lit(FILTER_BITS))
    needed = pairs.select(F.col("a").alias("v")).union(pairs.select("b")).select(bit.alias("bit"))
    words = needed.groupBy(F.floor(F.col("bit") / 32768).alias("part")).agg(F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits")).collect()
    packed = np.zeros(-(-FILTER_BITS // 32768) * 4096, np.uint8)
    for r in words:
        packed[r["part"] * 4096 : (r["part"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    sent = spark.sparkContext.broadcast(packed)
    sets = texts.where("_key IS NOT NULL").select(F.col("_key").alias("v"), F.col("_text")).mapInArrow(lambda it: _wanted(it, sent.value, form), "v long, cells binary")
    salts = pairs.groupBy("b").agg(F.ceil(F.count("*") / SALT).alias("salts"))
    salted = pairs.join(salts.withColumnRenamed("b", "_b"), F.col("b") == F.col("_b")).withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")))
    routes = salted.select(F.col("a").alias("w"), F.col("b").alias("centre"), "salt", F.lit(True).alias("member")).union(
        salts.select(F.col("b"), F.col("b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)), F.lit(False))
    )
    routed = sets.join(stage(routes, "routes"), F.col("v") == F.col("w")).select("centre", "salt", "member", "v", "cells")
    dealt = routed.repartition("centre", "salt").sortWithinPartitions("centre", "salt", "member")
    return stage(dealt.mapInArrow(lambda it: _compare(it, alike), "a long, b long").distinct(), "links")


def _fits(n, m):
    """Sets of these sizes can be similar enough at all."""
    return (100 * F.least(n, m)) >= (PERCENT * F.greatest(n, m))


def _least_shared(n, m):
    """Prefix shingles that similar sets of these sizes share at least.

    They share c = ceil(0.8 / 1.8 (n + m)) shingles or more; of these at most n less its prefix lie behind the one prefix,
    m less its prefix behind the other, and those in both prefixes are the first ones in the common order.
    """
    c = F.floor((PERCENT * (n + m) + 99 + PERCENT) / (100 + PERCENT))
    return c - F.floor((PERCENT * F.greatest(n, m) + 99) / 100) + 1


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_shingles (size of its set) and component_id, the smallest key reachable by links.

    Words are runs of non-space characters, A-Z lower-cased; a set has the distinct 5-word shingles, as 64-bit hashes,
    or all words as one shingle where there are fewer.  Two documents link when their sets' intersection is at least
    80 per cent of the union.

    Equal sets are one vertex.  Sets with the same prefix and size form a group, and groups meet by shared prefix
    shingles, common shingles coming last in the order, with groups of sizes that allow a link.  Each group is verified against
    one group per shingle first, once, which joins copies of a text without forming their pairs; then, between groups that are not yet joined, all pairs
    that can be similar by size and by what can follow the first shingle they share are expanded and verified, and with them all pairs inside
    a group that is not one component yet.  Pairs within a component say nothing new and are not formed; every other candidate is.  The tables the joins read are written ones.

    A missing or empty text has no shingles and is linked with nothing.  Rows with equal keys are one document (their
    texts count as linked); rows without key get a size and no component.  An empty table gives an empty result; other
    columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(key).cast("long").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    folder = new_folder(spark)
    schema = "common boolean, doc_id long, n int, set_id binary, hash long, times long"
    read = spark.read.schema(schema).parquet(save_stage(texts.mapInArrow(_read, schema), "read", folder, ["common"]))
    sizes = read.where("NOT common").select("doc_id", "n", "set_id")
    vertices = stage(sizes.where("set_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("v")), "vertices")

    common = spark.sparkContext.broadcast(_common(read))
    posted = texts.where("_key IS NOT NULL").mapInArrow(lambda it: _post(it, common.value), "kind int, hash long, gid long, place long, doc long, set_id binary")
    # one shuffle for all: postings of several groups, once each, that have a group of a similar size; beside them the group of
    # the smallest document, if sizes allow.  What is posted by one side of a pair that fits in size is posted by the other.
    over = Window.partitionBy("hash", "kind")
    n, i = F.shiftright("place", 32).cast("int"), F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    shared = (
        posted.withColumn("_least", F.min("gid").over(over)).withColumn("_most", F.max("gid").over(over))
        .where("kind = 1 OR _least <> _most").groupBy("kind", "hash", "gid", "place", "set_id").agg(F.min("doc").alias("doc"))
        .select("kind", "hash", "gid", n.alias("n"), i.alias("i"), "doc", "set_id")
    )
    by_size = over.orderBy("n", "gid")
    shared = shared.withColumns({"_below": F.lag("n").over(by_size), "_above": F.lead("n").over(by_size)}).where(
        (F.col("kind") == 1) | (F.col("_below").isNotNull() & _fits(F.col("n"), F.col("_below"))) | (F.col("_above").isNotNull() & _fits(F.col("n"), F.col("_above")))
    ).drop("_below", "_above")
    meets = (F.col("kind") == 0) & (F.col("gid") != F.col("_rep.gid")) & _fits(F.col("n"), F.col("_rep.n"))
    shared = shared.withColumn("_rep", F.min(F.struct("doc", "gid", "n")).over(over)).select(
        "kind", "hash", "gid", "n", "i", "set_id", F.when(meets, F.col("_rep.gid")).alias("other"), F.when(meets, F.col("_rep.n")).alias("m")
    )
    shared = spark.read.schema(shared.schema).parquet(save_stage(shared, "shared", folder, ["kind"]))
    members = stage(
        shared.where("kind = 1").select("gid", "set_id", F.col("hash").alias("end")).distinct().join(vertices, "set_id").select("gid", "v", "end").distinct(),
        "members",
    )
    postings = shared.where("kind = 0").select("hash", "gid", "n", "i")

    # links of all texts of a key with the smallest, and of members of a group with its first
    keyed = sizes.where("doc_id IS NOT NULL").join(vertices, "set_id").groupBy("doc_id").agg(F.min("v").alias("a"), F.max("v").alias("most"))
    several = stage(keyed.where("a <> most").select("doc_id", "a"), "several")
    same = sizes.join(several, "doc_id").join(vertices, "set_id").where("v <> a").select("a", F.col("v").alias("b")).distinct()
    firsts = members.groupBy("gid").agg(F.min("v").alias("first"))
    star = members.join(firsts, "gid").where("v <> first").select(F.col("v").alias("a"), F.col("first").alias("b"))
    # each group with the group of the smallest document among those of a shingle: the one it shares most with
    met = shared.where("kind = 0 AND other IS NOT NULL").groupBy("gid", "n", "other", "m").count().where(F.col("count") >= _least_shared(F.col("n"), F.col("m")))
    met = met.join(firsts.withColumnRenamed("first", "a"), "gid").join(firsts.select(F.col("gid").alias("other"), F.col("first").alias("b")), "other")
    best = met.where("a <> b").groupBy("a").agg(F.max_by("b", F.struct("count", "b")).alias("b"))
    links = stage(same.union(verify(texts, star.union(best).distinct())), "links")
    labels = components(links)

    own = stage(members.join(labels, "v", "left").select("gid", "v", F.coalesce("label", "v").alias("label")), "own")
    grouped = own.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    of_hash = Window.partitionBy("hash")  # rows move by group, for the labels, and by shingle, each time as few columns as can be
    spread = postings.join(grouped, "gid").withColumns({"_low": F.min("low").over(of_hash), "_high": F.max("high").over(of_hash)})
    rest = stage(spread.where("_low <> _high").drop("_low", "_high"), "rest")

    # Every pair of groups that is not within one component yet, by the first shingle they share.  What they share is at most
    # that one and what follows it.  Of a prefix that ends first, all that the pair shares is posted by both sides, so only
    # shingles still in question (those of `rest`) count there; behind a prefix, and in the other one, everything may be shared.
    col = F.col
    rest = rest.withColumn("after", F.row_number().over(Window.partitionBy("gid").orderBy(col("i").desc())) - 1)
    rest = rest.join(members.groupBy("gid").agg(F.max("end").alias("end")), "gid")
    rest = stage(rest.withColumn("left", col("after") + F.floor((PERCENT * col("n") + 99) / 100) - 1), "ranked")
    a, b = rest.alias("a"), rest.alias("b")
    needed = F.floor((PERCENT * (col("a.n") + col("b.n")) + 99 + PERCENT) / (100 + PERCENT))
    ends = F.when(col("a.end") < col("b.end"), col("a.left")).when(col("a.end") > col("b.end"), col("b.left")).otherwise(F.greatest("a.left", "b.left"))
    bound = 1 + F.least(ends, col("a.n") - 1 - col("a.i"), col("b.n") - 1 - col("b.i"))
    open_pair = (col("a.low") != col("b.low")) | (col("a.low") != col("a.high")) | (col("b.low") != col("b.high"))
    pairs = a.join(
        b, (col("a.hash") == col("b.hash")) & (col("a.gid") < col("b.gid")) & open_pair & _fits(col("a.n"), col("b.n")) & (bound >= needed)
    ).select(col("a.gid").alias("g"), col("b.gid").alias("h")).distinct()
    expanded = (
        pairs.join(own.select(col("gid").alias("g"), col("v").alias("a"), col("label").alias("x")), "g")
        .join(own.select(col("gid").alias("h"), col("v").alias("b"), col("label").alias("y")), "h")
        .where("x <> y").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    # and every pair inside a group that is not one component yet, whatever the group shares with others; its first is done
    apart = own.join(grouped.where("low <> high").select("gid"), "gid").join(firsts, "gid").where("v <> first").select("gid", "v", "label")
    apart = stage(apart, "apart")
    a, b = apart.alias("a"), apart.alias("b")
    inside = a.join(b, (col("a.gid") == col("b.gid")) & (col("a.v") < col("b.v")) & (col("a.label") != col("b.label"))).select(col("a.v").alias("a"), col("b.v").alias("b"))
    expanded = expanded.union(inside).distinct()
    more = verify(texts, expanded.join(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
    named = labels.select("v", "label")
    lifted = more.join(named.withColumnsRenamed({"v": "a", "label": "x"}), "a", "left").join(named.withColumnsRenamed({"v": "b", "label": "y"}), "b", "left")
    top = components(lifted.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")))
    final = vertices.join(named, "v", "left").select("set_id", F.coalesce("label", "v").alias("label"))
    final = stage(
        final.join(top.select(F.col("v").alias("label"), F.col("label").alias("root")), "label", "left").select("set_id", F.coalesce("root", "label").alias("root")), "roots"
    )
    # a set that very many rows have is one row here, and both sides are shuffled, so that the join can split it
    out = sizes.join(final, "set_id", "left")
    return out.select(
        F.col("doc_id").alias(key), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
    )


def drop_linked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, unchanged, less those linked to one with a smaller key: one of each component stays.

    Of rows with equal keys one stays, the first by text and then by the other columns.  Rows without key stay.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at, rows = names[docs.columns.index(key)], docs.toDF(*names)
    linked = stage(link_documents(docs, key, text).select(F.col(key).alias("_id"), "component_id"), "linked")
    gone = stage(linked.where("component_id <> _id").select("_id").distinct(), "gone")
    rows = rows.join(gone, F.col(at) == F.col("_id"), "left_anti")
    repeated = stage(linked.where("_id IS NOT NULL").groupBy("_id").count().where("count > 1").select("_id"), "repeated")
    if not repeated.isEmpty():
        again = rows.join(repeated, F.col(at) == F.col("_id"), "left_semi")
        least = F.min(F.struct(names[docs.columns.index(text)], *[F.col(c).alias(f"_own{c}") for c in names])).alias("_row")
        again = again.groupBy(at).agg(least).select(*[F.col(f"_row._own{c}").alias(c) for c in names])
        rows = rows.join(repeated, F.col(at) == F.col("_id"), "left_anti").unionByName(again)
    return rows.toDF(*docs.columns)
