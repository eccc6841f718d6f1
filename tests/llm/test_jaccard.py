"""The grouped prefix join beside all pairs of sets."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelens.llm import jaccard
from carelens.llm.components import components


def plain(rows):
    """(id, n_shingles, component) of every row, by comparing everything with everything."""
    sets = []
    for i, text in rows:
        words = (text or "").encode().lower().split()
        k = min(5, len(words))
        sets.append({tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if words else set())
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for p, (i, _) in enumerate(rows):
        for q in range(p):
            j = rows[q][0]
            if i is None or j is None or not sets[p] or not sets[q]:
                continue
            both = len(sets[p] & sets[q])
            if 100 * both >= 80 * (len(sets[p]) + len(sets[q]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)), key=str)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        at = rng.randrange(len(out))
        out[at : at + rng.choice([0, 1, 1])] = [f"w{rng.randrange(10**6)}"]
    return " ".join(out)


def cases():
    rng = random.Random(5)
    texts = [None, "", " \n", "one", "ONE", "one two three four", "One Two three FOUR", "one two three four five", "a b a b a b a b a b a b", "É é", "é É"]
    for base in range(12):
        words = [f"t{rng.randrange(40 if base % 3 else 10**6)}" for _ in range(rng.randrange(8, 300))]
        for _ in range(12):
            texts.append(edited(rng, words, rng.choice([0, 1, 1, 2, 4, max(1, len(words) // 25)])))
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(40):  # a passage many texts share, and texts that are little else
        texts.append(passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.choice([0, 1, 5, 12, 20, 200]))))
    texts += ["x " * 30_000, "long " + " ".join(f"v{i}" for i in range(30_000))]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def got(df):
    return sorted((tuple(r) for r in jaccard.link_documents(df).collect()), key=str)


def test_links_beside_all_pairs(make):
    rows = cases()
    assert got(make(rows, component_id=1, v="x", label=2).repartition(3)) == plain(rows)


def test_links_with_common_shingles_found(make, monkeypatch):
    rows = cases()
    monkeypatch.setattr(jaccard, "COMMON", 4)
    monkeypatch.setattr(jaccard, "SALT", 3)
    assert got(make(rows).coalesce(1)) == plain(rows)


def chain(rng):
    """Three texts of equal size and prefix, the middle one similar to both others, which are not similar to each other."""
    while True:
        words = [f"c{rng.randrange(10**9)}" for _ in range(58)]
        texts = [words[:10] + ["left"] + words[11:], words, words[:40] + ["right"] + words[41:]]
        texts = [" ".join(t) for t in texts]
        firsts = [jaccard.prefix(jaccard.shingles(t.encode()), (np.empty(0, np.uint64), np.empty(0, np.int64))).tolist() for t in texts]
        if firsts[0] == firsts[1] == firsts[2]:
            return texts, words, firsts[0]


@pytest.mark.parametrize("beside", [False, True])
def test_links_inside_a_group(make, beside):
    rng = random.Random(11)
    rows = []
    for at in range(4):
        (left, middle, right), words, first = chain(rng)
        rows += [(10 * at + 1, left), (10 * at + 2, middle), (10 * at + 3, right)] if at % 2 else [(10 * at + 1, right), (10 * at + 3, middle), (10 * at + 2, left)]
        while beside:  # another group that shares one shingle of the prefix
            k = next(k for k in range(54) if jaccard.shingles(" ".join(words[k : k + 5]).encode())[0] == first[0])
            other = " ".join(words[k : k + 5] + [f"d{rng.randrange(10**9)}" for _ in range(53)])
            if first[0] in jaccard.prefix(jaccard.shingles(other.encode()), (np.empty(0, np.uint64), np.empty(0, np.int64))).tolist():
                rows.append((10 * at, other))
                break
    want = plain(rows)
    assert len({c for _, _, c in want}) == (8 if beside else 4)
    assert got(make(rows)) == want


def test_one_hash_for_every_length(monkeypatch):
    rng = random.Random(3)
    words = [("w" * rng.choice([1, 3, 60, 300]) + str(rng.randrange(500))).encode() for _ in range(400)]
    for n in (1, 3, 5, 6, 400):
        assert jaccard._long_runs(words[:n]).tolist() == jaccard._runs(words[:n]).tolist()
    want = jaccard._runs(words).tolist()
    monkeypatch.setattr(jaccard, "STRETCH", 64)
    assert jaccard._runs(words).tolist() == want


def test_links_of_texts_on_both_sides_of_a_stretch(make):
    plenty = " ".join(f"o{i}" for i in range(10_000))
    blob = "QUJD" * 300_000  # a word of 1.2 MB
    long = [f"{i:07}" * 10 for i in range(14_990)]  # texts of 71 bytes a word, close to 1 MiB
    rows = [(1, plenty), (2, f"{plenty} {blob}"), (3, f"{plenty} {blob[:900_000]}"), (4, blob), (5, f"a {blob}"), (6, blob)]
    rows += [(11, " ".join(long[:14_700])), (12, " ".join(long))]
    assert len(rows[-2][1]) < jaccard.STRETCH < len(rows[-1][1])
    want = plain(rows)
    assert [c for _, _, c in sorted(want)] == [1, 1, 1, 4, 5, 4, 11, 11]
    assert got(make(rows)) == want


def test_missing_and_equal_keys(make):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(7, text), (7, text), (3, text + " a"), (None, text), (None, None), (9, "x y z a b c"), (9, "other words here for nine now"), (11, "x y z a b c"), (4, "other words here for nine now")]
    assert got(make(rows)) == sorted(
        [(7, 36, 3), (7, 36, 3), (3, 37, 3), (None, 36, None), (None, 0, None), (9, 2, 4), (9, 2, 4), (11, 2, 4), (4, 2, 4)], key=str
    )
    assert got(make(rows).limit(0)) == []


def test_every_text_of_a_key_links(make):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(3, a), (5, b), (6, c), (9, a), (9, b), (9, c), (9, d), (20, d + " e"), (21, "others")]
    want = plain(rows)
    assert {i: k for i, _, k in want} == {3: 3, 5: 3, 6: 3, 9: 3, 20: 3, 21: 21}
    assert got(make(rows)) == want


def test_one_row_of_a_repeated_id(make):
    rows = make([(7, "some text here b"), (7, None), (8, "other things z"), (8, "other things a"), (8, "other things a"), (9, "alone")], more=1)
    kept = jaccard.drop_linked(rows.withColumn("n_chars", F.monotonically_increasing_id()))
    assert kept.columns == rows.columns and "Window" not in kept._jdf.queryExecution().toString()
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(7, None), (8, "other things a"), (9, "alone")]


def test_given_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    result = got(docs)
    assert result == plain(rows)
    assert len({c for _, _, c in result}) < len(rows)


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(1)
    links = {"chain": [(i, i + 1) for i in range(40)], "star": [(500, i) for i in range(100, 160)], "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]}[shape]
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b), near[b].add(a)
    want = {}
    for v in sorted(near):
        stack = [] if v in want else [v]
        while stack:
            x = stack.pop()
            if x not in want:
                want[x] = v
                stack += near[x]
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.v: r.label for r in components(df).collect()} == {v: c for v, c in want.items() if near[v] != {v}}
    assert components(df.limit(0)).collect() == []


def test_sketches_lose_no_similar_pair():
    rng = np.random.default_rng(4)
    kept = 0
    for n in (1, 2, 5, 9, 40, 300, 2_000, 20_000):
        for share in (0.0, 0.3, 0.7, 0.78, 0.8, 0.82, 0.95, 1.0):
            both = round(share * n)
            a = np.unique(rng.integers(0, 2**64, n, np.uint64))
            b = np.unique(np.concatenate([a[:both], rng.integers(0, 2**64, rng.integers(0, n - both + 1), np.uint64)]))
            if len(b):
                likely = jaccard.may_be_similar(jaccard.sketch(a), jaccard.sketch(b))
                assert likely or not jaccard.similar(a, b)
                kept += likely and n <= 300 and share <= 0.3 and n > 5
    assert kept == 0  # what has little in common is told apart


def test_whole_sets_move_for_likely_pairs_only(make, monkeypatch):
    """Texts of one size that share seven tenths of their shingles, and one true pair among them."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(100)]
    rows = [(i, " ".join(passage + [f"u{rng.randrange(10**9)}" for _ in range(20)])) for i in range(12)]
    rows.append((20, rows[3][1] + " more"))
    moved, plainly = {}, jaccard._alike

    def spied(texts, pairs, form, alike):
        moved[alike.__name__] = moved.get(alike.__name__, 0) + pairs.count()
        return plainly(texts, pairs, form, alike)

    monkeypatch.setattr(jaccard, "_alike", spied)
    monkeypatch.setattr(jaccard, "COMMON", 10**9)  # else the passage comes last and none of it is posted
    assert got(make(rows)) == plain(rows)
    assert moved["may_be_similar"] > 5 and moved["similar"] == 1


def test_groups_whose_sizes_do_not_fit_are_not_posted(make, monkeypatch):
    """A passage alone, and in texts of twice, four and eight times its size: no two of them can be similar."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(k, " ".join([passage] + [f"u{k}x{i}" for i in range(40 * (2**k - 1))])) for k in range(4)]
    rows += [(10, rows[2][1]), (11, rows[2][1] + " more")]
    seen, plainly = {}, jaccard.save_stage

    def spied(df, name, *rest):
        path = plainly(df, name, *rest)
        if name == "shared":
            seen[name] = {r["gid"]: r["n"] for r in df.sparkSession.read.parquet(path).where("kind = 0").select("gid", "n").collect()}
        return path

    monkeypatch.setattr(jaccard, "save_stage", spied)
    monkeypatch.setattr(jaccard, "COMMON", 10**9)
    assert got(make(rows)) == plain(rows)
    assert sorted(seen["shared"].values()) == [156, 157]
