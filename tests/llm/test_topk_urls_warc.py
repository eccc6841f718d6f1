"""URL filter, exact search and archives: hand-written cases and brute force."""

import hashlib
import io
import random
import time
from fractions import Fraction

import numpy as np
import pyarrow.fs as pafs
import pytest
import zstandard
from pyspark.sql import functions as F

from carelens.llm import topk, urls, warc

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de", "block"), ("org", "", "allow"), ("Www.Example.net", "/en/", "block")]


def _judge(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = []
    for h, p, v in rules:
        h = h.lower()
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), len(h), v == "block", h + p, v))
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


URLS = [
    "https://a.example.net/en/1?x#y", "https://A.EXAMPLE.net/de/", "https://example.net", "https://www.example.net/en/", "ftp://example.com/de",
    "http://xexample.com/de/1", "http://é.org/ü?://b.net/", "mailto:me", "", None, "://", "http:///en/", "http://net/", "http://net", "x://y.net/a\nb",
    "https://a.example.net/en/1?x#y", "http://example.net:80/en/", "http://..net/", "http://" + "a." * 300 + "net/" + "p" * 5000, "http://a.org?q=/",
]


def test_urls_beside_a_loop(spark, rows):
    df = spark.createDataFrame([(i, u, "k", 1) for i, u in enumerate(URLS)] + [(None, URLS[0], "k", 1)], "page_id long, url string, host string, _won int")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = rows(urls.judge_urls(df, rules, "page_id", "url"))
    want = [(i, *_judge(u, RULES)) for i, u in enumerate(URLS)] + [(None, *_judge(URLS[0], RULES))]
    assert got == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_urls_equal_rules_and_no_rules(spark, rows):
    df = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    schema = "host string, path string, verdict string"
    both = spark.createDataFrame([("net", "/", "allow"), ("net", "/", "block"), (None, "/", "block"), ("net", None, "block"), ("", "/", "block")], schema)
    assert rows(urls.judge_urls(df, both, "page_id", "url")) == [(1, "a.net", "/x", "net/", "block")]
    assert rows(urls.judge_urls(df, both.limit(0), "page_id", "url", default="block")) == [(1, "a.net", "/x", None, "block")]
    assert rows(urls.judge_urls(df.limit(0), both, "page_id", "url")) == []


def _best(vectors, k):
    out = []
    usable = [(i, v) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in usable]
    for q, qv in {i: v for i, v in sorted(whole, key=lambda p: p[1], reverse=True) if i % 50 == 0}.items():
        scores = sorted((-max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(qv, v)))), i) for i, v in whole if i != q and len(v) == len(qv))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("case", ["random", "ties", "few", "huge", "odd"])
def test_top_k_beside_brute_force(spark, case):
    r = random.Random(3)
    if case == "random":
        vectors = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    elif case == "ties":
        vectors = [(i, [0.5, 0.25] if i % 3 else [r.choice([0.1, 0.2]), 0.0]) for i in range(300)]
    elif case == "few":
        vectors = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [-1.0, -1.0])]
    elif case == "huge":
        vectors = [(i, [r.uniform(-1, 1) * 10 ** r.choice([0, 7, 12, 300]) for _ in range(3)]) for i in range(120)]
    else:
        vectors = [(0, [1.0, 2.0]), (0, [1.0, 1.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]),
                   (5, [1.0]), (6, []), (8, [1.0, 1.0]), (8, [1.0, 1.0]), (9, [-1.0, 0.5]), (50, []), (-50, [3.0, 3.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = sorted(tuple(x) for x in topk.top_k(df, F.col("vec_id") % 50 == 0, k=5).collect())
    assert got == _best(vectors, 5)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_top_k_in_several_waves(spark, monkeypatch):
    monkeypatch.setattr(topk, "WAVE", 3)
    vectors = [(i * 10, [float(i % 7), float(i % 5)]) for i in range(100)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    assert sorted(tuple(x) for x in topk.top_k(df, F.col("vec_id") % 50 == 0, k=5).collect()) == _best(vectors, 5)


PAGES = "page_id long, url string, html string, record_type string"


def test_archives_round_trip(spark):
    big, wide = "x" * 1000, "é" * 500
    data = [(1, "http://a/\r\nWARC-Type: evil", big), (5, "http://b/ü", big), (3, None, big), (2, "u", "x" * 999), (4, "u", "x" * 999), (6, "u", None),
            (7, "", ""), (8, "u", wide), (9, "u", wide), (None, "u", big), (None, None, None), (9, "u", wide), (10, "u", "tail\r\n\r\nWARC/1.1\r\n" * 90),
            (11, "u", "long " * 300_000)]
    df = spark.createDataFrame([(*r, "x") for r in data], PAGES).repartition(3)
    last = {}
    for p, _, h in data:
        if p is not None and h is not None and len(h.encode()) >= 1000:
            last[h] = max(p, last.get(h, p))
    want = []
    for p, _, h in data:
        raw = (h or "").encode()
        to = last.get(h) if p is not None else None
        to = None if to is None or to == p else to
        want.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if to is not None else "response", to))
    got = [tuple(r)[:5] for r in warc.archive_round_trip(df).collect()]
    order = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert warc.archive_round_trip(df.limit(0)).collect() == []


def test_archive_layout(spark, tmp_path):
    """A leading skippable frame with the dictionary, then one frame per record, each readable by itself."""
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").coalesce(1)
    [file] = warc.write_archives(df, str(tmp_path)).collect()
    fs, base = pafs.FileSystem.from_uri(file.path)
    raw = fs.open_input_stream(base).read()
    assert raw[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(raw[4:8], "little")
    packer = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size]))
    at, n = 8 + size, 0
    while at < len(raw):
        assert raw[at : at + 4] == bytes.fromhex("28b52ffd")
        one = packer.decompressobj()
        assert one.decompress(raw[at:]).startswith(b"WARC/1.1\r\n")
        at, n = len(raw) - len(one.unused_data), n + 1
    assert n == file.records == df.count()


def test_damaged_archives_are_refused():
    data = b"".join(warc.make_record(i, "u", b"p" * 50, None, None) for i in range(3))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(zstandard.compress(data))))


def test_components_beyond_the_range_of_doubles(spark):
    """Finite components whose scaled value no double holds: scores are still those of whole numbers."""
    big = 2.0**1016  # 256 times this is infinite
    vectors = {0: [1e308, -3.0], 50: [big, big], 1: [1e308, 2.0], 2: [1.5, -1e308], 3: [big, -big], 4: [-big, big + 2.0**970], 100: [0.0, 0.5], 5: [1e-3, 0.25], 6: [float("inf"), 1.0], 7: [2.0**40, 2.0**41]}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0).collect()))
    top = 2**63 - 1
    whole = {i: [int(Fraction(x) * 256 // 1) for x in v] for i, v in vectors.items() if i != 6}
    want = []
    for q in (0, 50, 100):
        found = sorted((-max(-top, min(top, sum(a * b for a, b in zip(whole[q], v)))), i) for i, v in whole.items() if i != q)
        want += [(q, rank, i, -score) for rank, (score, i) in enumerate(found[:5], 1)]
    assert got == want


def test_many_rules_of_many_shapes(spark):
    """100,000 rules with hundreds of path lengths; a URL meets only the lengths of its own hosts."""
    rules = [(f"h{i % 5000}.example.com", "/" + "a" * (i % 400) + str(i), "block" if i % 3 else "allow") for i in range(100_000)]
    rules += [("example.com", "/", "block"), ("h7.example.com", "/" + "a" * 7, "allow")]
    urls = [(1, "http://x.h7.example.com/" + "a" * 7 + "7"), (2, "http://h7.example.com/aaaaaaaa"), (3, "http://h7.example.com/b"), (4, "http://example.org/"), (5, None), (6, "http://h4999.example.com/" + "a" * 399 + "99999/x")]
    start = time.time()
    got = {r.page_id: (r.rule, r.verdict) for r in urls_of(spark, urls, rules)}
    assert got == {
        1: ("h7.example.com/" + "a" * 7 + "7", "block"), 2: ("h7.example.com/aaaaaaa", "allow"), 3: ("example.com/", "block"), 4: (None, "allow"), 5: (None, "allow"),
        6: ("h4999.example.com/" + "a" * 399 + "99999", "allow"),
    }
    assert time.time() - start < 120


def urls_of(spark, pages, rules):
    pages = spark.createDataFrame(pages, "page_id long, url string")
    return urls.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), "page_id", "url").collect()


def test_schemes_of_stores(spark, tmp_path):
    assert warc._as_uri("s3a://bucket/x") == "s3://bucket/x" and warc._as_uri("/data/x") == "file:///data/x" and warc._as_uri("hdfs://n/x") == "hdfs://n/x"
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    with pytest.raises(ValueError, match="dbfs"):
        warc.write_archives(pages, "dbfs:/somewhere/x")
