"""Fill-in-the-middle, phrase mining and line dedup beside the plain definitions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carelens.llm import fim, line_dedup, phrases
from carelens.llm.common import BATCH_BYTES, parts, small_batches
from carelens.llm.queries import CHECKS, QUERIES
from workload.check import compare, connect

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]")


@pytest.mark.parametrize("key", ["op11_fill_in_middle", "op12_phrase_mining", "op13_line_dedup"])
def test_beside_sql(spark, sf, key):
    assert compare(spark, connect(sf), sf, QUERIES[key], CHECKS[key]) == ""


def test_parts_are_bounded_by_rows_and_bytes():
    sizes = [10, 0, None, 5, 100, 1, 1, 1, 50, 50]
    b = pa.record_batch([pa.array(range(10)), pa.array([None if n is None else "x" * n for n in sizes])], ["a", "t"])
    got = [p.column(0).to_pylist() for p in parts(b, 1, rows=4, size=60)]
    assert sum(got, []) == list(range(10)) and max(map(len, got)) <= 4
    assert all(len(g) == 1 or sum(sizes[i] or 0 for i in g) <= 60 for g in got)
    big = pa.record_batch([pa.array(["y" * (1 << 20)] * 60)], ["t"])
    assert [p.num_rows for p in parts(big, 0)] == [8] * 7 + [4]
    assert list(parts(b.slice(0, 0), 1)) == []


# -- fill in the middle


def plain_cut(text, key, seed=1, percent=90, spm=20):
    units = UNITS.findall(text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h4 % 100 < spm else "psm", len(p), len(m), out


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("abZ é🙂\n<P>SM\x00ſK@[`{")), max_size=60), st.integers(-5, 10**12))
def test_cut_equals_the_plain_one(text, key):
    assert fim.transform(text, str(key), 1, 90, 20) == plain_cut(text, key)


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_tree_finds_every_place(block, monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", block)
    for text in ("", "a", "abc", "ab c  dé🙂efg", "é" * 30, "x" * 50, "word, another one.\n" * 9):
        tree, units = fim.UnitTree(text), UNITS.findall(text)
        assert tree.total == len(units)
        assert [tree.place_after(i) for i in range(len(units) + 1)] == [len("".join(units[:i])) for i in range(len(units) + 1)]


def test_fill_in_middle_of_odd_rows(spark, make):
    texts = [None, "", "one two", (None, "no key"), (None, None), (7, "again"), (7, "again"), "a <P> b", "<M", "<S" * 9, "x" * 300_000, "é🙂 " * 50_000, "\n\n"]
    df = make([t if isinstance(t, tuple) else (100 + i, t) for i, t in enumerate(texts)], n="clash", form=1, output="other")
    made = fim.fill_in_middle(df)
    got = Counter(map(tuple, made.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()))
    want = Counter()
    for r in df.collect():
        text = r.text or ""
        want[(r.doc_id, *plain_cut(text, "" if r.doc_id is None else r.doc_id), text)] += 1
    assert got == want
    assert fim.fill_in_middle(df.limit(0)).collect() == []


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab<PSM> 🙂")), max_size=20), min_size=1, max_size=30))
def test_restored_text_is_the_text(spark, texts):
    made = fim.fill_in_middle(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), seed=3, percent=100, spm_percent=50)
    got = {r.doc_id: r.back for r in made.select("doc_id", fim.restore(F.col("output"), F.col("form")).alias("back")).collect()}
    assert got == dict(enumerate(texts))


# -- phrases


def plain_counts(rows, longest):
    words, counts = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang if lang is not None else "und", text or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            own = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(own)
            counts.update((lang, *own[i : i + k]) for k in range(1, longest + 1) for i in range(len(own) - k + 1))
    return words, counts


def plain_phrases(rows, longest=3, least=10, inside=50, top=2000):
    words, counts = plain_counts(rows, longest)
    found = {p: f for p, f in counts.items() if len(p) > 2 and f >= least}
    gone = set()
    for p, f in found.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                part = (p[0], *p[i : i + k])
                if 100 * f >= inside * found[part]:
                    gone.add(part)
    by_lang = defaultdict(list)
    for p, a in found.items():
        if p not in gone:
            cuts = [(10**6 * a * a // (counts[p[: k + 1]] * counts[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
            score, k = min(cuts)
            by_lang[p[0]].append((-score, -a, " ".join(p[1:]).encode(), counts[p[: k + 1]], counts[(p[0], *p[k + 1 :])]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, words[lang], -score)
        for lang, own in by_lang.items() for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1)
    )


def mined(df, **how):
    return sorted(map(tuple, phrases.mine_phrases(df, **how).collect()))


ODD = [
    (1, None, "en"), (2, "", None), (3, "New york city. new York CITY, new york", None), (4, "a b a b a b\ta b", "en"), (5, "a b a b a b\ta b", "en"),
    (None, "é ü é ü; é ü é", "fr"), (None, "é ü é ü; é ü é", "fr"), (6, "x", "und"), (7, "new york city\x0bnew york\x0ccity", "und"), (8, ".,;:!?\n\r", "en"), (9, "one,two one two", ""),
    (10, "a\x00b \x1c c a\x00b \x1c c   d   d", "en"), (11, "🙂 🙂 🙂 🙂 🙂", "\n"), (12, "🙂 🙂 ﬁ ﬁ", "\n"),
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.mark.parametrize("how", [{"least": 1}, {"least": 2}, {"least": 2, "inside": 90, "longest": 4}, {"least": 1, "longest": 2, "top": 3}, {"least": 2, "longest": 5, "top": 4}])
def test_phrases_of_odd_rows(spark, how):
    df = spark.createDataFrame(ODD, SCHEMA).withColumn("a", F.lit(1)).withColumn("n", F.lit("x")).withColumn("h1", F.lit(2))
    assert mined(df, **how) == plain_phrases([(lang, t) for _, t, lang in ODD], **how)
    assert mined(df.limit(0), **how) == []


def test_long_pieces_come_in_runs(spark, monkeypatch):
    """A piece beyond a block is cut into runs that know the words behind them."""
    made = np.random.default_rng(5).integers(0, 6, 4000)
    rows = [("en", " ".join(f"w{x}" for x in made)), ("en", "w1 w2 w3"), ("fr", " ".join(f"w{x}" for x in made[:50]))]
    for block, run in ((64, 3), (64, 1), (1000, 7), (50, 400)):
        monkeypatch.setattr(phrases, "BLOCK", block), monkeypatch.setattr(phrases, "RUN", run)
        for longest in (2, 3, 4):
            blocks = [b for b in phrases._occurrences(iter([pa.record_batch([pa.array([x for x, _ in rows]), pa.array([t for _, t in rows])], ["lang", "t"])]), longest - 1)]
            counts = Counter()
            everything = np.full(-(-phrases.FILTER_BITS // 8), 255, np.uint8)
            for level in range(1, longest):
                for b in phrases._count_groups(iter(blocks), level, 0, everything):
                    for *h, n in zip(*(c.to_pylist() for c in b.columns)):
                        counts[tuple(h)] += n
                blocks = list(phrases._next_relation(iter(blocks), level, 0, everything, everything))
            want = Counter()
            for p, f in plain_counts(rows, longest)[1].items():
                if len(p) > 2:
                    want[tuple(phrases.word_hash(w.encode(), p[0]) for w in p[1:])] += f
            assert +counts == want


def test_relations_are_written_and_read_in_small_pieces(spark, tmp_path, monkeypatch):
    """However many groups are frequent, and whatever a task holds: memory does not grow with either."""
    monkeypatch.setattr(phrases, "new_folder", lambda _: str(tmp_path))
    word = lambda i: F.conv(F.pmod(F.xxhash64("doc_id", i), F.lit(4000)).cast("string"), 10, 16)
    df = spark.range(800).withColumnRenamed("id", "doc_id").coalesce(1)
    df = df.select("doc_id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2000)), word), " ").alias("text"), F.lit("en").alias("lang"))
    phrases.count_phrases(df, least=1)
    for name in ("words", "groups2"):
        files = [pq.ParquetFile(f) for f in (tmp_path / name).glob("*.parquet")]
        rows = [sum(map(len, (r["at"], r["own"], r["codes"], r["names"]))) for f in files for r in f.read().to_pylist()]
        assert sum(rows) > 7 << 20 > max(rows)
        assert max(f.metadata.row_group(g).total_byte_size for f in files for g in range(f.num_row_groups)) < 14 << 20


def test_batches_to_workers_are_small_meanwhile(spark):
    df = spark.range(400).coalesce(1).select(F.repeat(F.lit("x"), 100_000).alias("t"))

    def sizes(it):
        for b in it:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    def largest():
        return df.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]

    assert spark.conf.get(BATCH_BYTES, None) is None and largest() > 30 << 20
    with pytest.raises(KeyError), small_batches(spark):
        assert largest() < 5 << 20
        raise KeyError
    assert spark.conf.get(BATCH_BYTES, None) is None
    spark.conf.set(BATCH_BYTES, str(1 << 20))
    try:
        with small_batches(spark):
            assert largest() < 2 << 20
        assert spark.conf.get(BATCH_BYTES) == str(1 << 20)
    finally:
        spark.conf.unset(BATCH_BYTES)


def test_filter_bits_are_the_same_on_both_sides(spark):
    groups = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, (200, 5), dtype=np.int64)
    for k in range(1, 6):
        df = spark.createDataFrame([tuple(int(x) for x in g[:k]) for g in groups], ", ".join(f"h{i + 1} long" for i in range(k)))
        assert [r[0] for r in df.select(phrases._bit(k)).collect()] == phrases._bits(groups[:, :k]).tolist()
        bits = phrases.filter_of(df, k)
        assert phrases._semi(groups[:, :k], np.arange(200), bits).all()


def test_scores_beyond_64_bits(spark):
    a, left, right = 3 * 10**15 + 7, 5 * 10**15 + 1, 9 * 10**15 + 11
    counts = {1: spark.createDataFrame([(1, left), (2, right)], "h1 long, f long")}
    got = phrases._scored(spark.createDataFrame([(1, 2, a)], "h1 long, h2 long, f long"), counts, 2).select("cut.score", "cut.l", "cut.r").first()
    assert tuple(got) == (10**6 * a * a // (left * right), left, right)


def test_hash_collisions_are_an_error(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b a b", "en")], SCHEMA)
    clash = spark.createDataFrame([(1, "x", "a", 3), (1, "x", "b", 4)], "h1 long, lang string, word string, n long")
    real = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema, **k: clash if "word binary" in schema else real(self, f, schema, **k))
    with pytest.raises(ValueError, match="seed"):
        phrases.mine_phrases(df)


# -- lines


def plain_lines(rows, least_docs=2, least_chars=10):
    def key_of(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held[key_of(line)].add(doc)
    out = Counter()
    for doc, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            docs = held[key_of(line)]
            first = min((d for d in docs if d is not None), default=None)
            if len(key_of(line)) < least_chars or len(docs) < least_docs or doc == first:
                kept.append(line)
        out[(doc, len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    return out


def test_lines_of_odd_rows(spark, make):
    same = "A line that is shared"
    texts = [
        (5, f"{same}\nown of five\n{same}"), (9, f"  {same.upper()}\t\r\n\nown of nine"), (9, same.lower()), (9, same.lower()), (7, None), (8, ""), (None, same), (None, f"only without id\n{same}"),
        (None, "only without id"), (3, "short\nshort one\n123456789\n1234567890"), (4, "short\n123456789\n1234567890\n"), (11, "é" * 10), (12, "é" * 10), (13, "É" * 10),
        (14, "\n" * 5), (15, f"{same}\n" * 20_000 + "end of it all"), (16, same), (17, " padded line "), (18, "padded line"), (19, "nul \x00 in a line"), (20, "NUL \x00 in a line\x1c"), (-1, "é" * 9), (-2, "é" * 9),
    ]
    df = make(texts, hash="clash", pos=1, kept="x", _key=3)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    for how in ({}, {"least_docs": 3}, {"least_chars": 1}, {"least_chars": 0, "least_docs": 2}):
        got = Counter(map(tuple, line_dedup.drop_repeated_lines(df, **how).collect()))
        assert got == plain_lines(rows, **how)
    assert line_dedup.drop_repeated_lines(df.limit(0)).collect() == []


def test_lines_of_the_documents(spark, docs):
    got = Counter(map(tuple, line_dedup.drop_repeated_lines(docs).collect()))
    want = plain_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert got == want and sum(n * k[2] for k, n in want.items()) > 0


def test_lines_beside_text_ids(spark):
    df = spark.createDataFrame([("b", "the very same line"), ("a", "the very same line"), (None, "the very same line")], "name string, body string")
    got = sorted(map(tuple, line_dedup.drop_repeated_lines(df, "name", "body").collect()), key=str)
    assert got == sorted([("a", 1, 0, "the very same line"), ("b", 1, 1, ""), (None, 1, 1, "")], key=str)
