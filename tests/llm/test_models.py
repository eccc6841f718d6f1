"""Language models, quality rules and mixing beside plain versions; held-out accuracy."""

import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from carelens.llm import langid, mixing, quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def hash_of(*values):
    """Spark's xxhash64: seed 42, each value's hash being the seed of the next."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed=h)
    return signed(h)


def plain_quality(rows, trusted, threshold):
    def hashes(text):
        ones = [hash_of(w) for w in WORD.findall(text or "")]
        return ones + [hash_of(*ones[i : i + 2]) for i in range(len(ones))]

    raw, target = Counter(), Counter()
    for i, text in rows:
        found = Counter(h % quality.BUCKETS for h in hashes(text))
        raw.update(found)
        if i in trusted:
            target.update(found)
    n, t = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    out = []
    for i, text in rows:
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        times = Counter(windows)
        covered = {k + d for k, w in enumerate(windows) if times[w] > 1 for d in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        own = [h % quality.BUCKETS for h in hashes(text)]
        llr = sum(math.log((target[b] + 1) / t) - math.log((raw[b] + 1) / n) for b in own) / len(own) if own else None
        out.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed, llr, not failed and llr >= threshold))
    return out


ODD = [None, "", " ", "a", "a b", "a b c", "a b c a b c", "é 🙂 é 🙂 é", "x\x0by\x0cz\r\n\tq r", "# $ % & | < > * ## a", "one\n\none\n one\none\n\x0b\ntwo\ntwo", "w " * 9000,
       " ".join(f"n{i}" for i in range(20_000)), "a b c " * 16 + "d e", " ".join(f"m{i % 60}" for i in range(120))]


def check_quality(df, labels, trusted):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = quality.quality_rules(df, labels).collect()
    order = lambda r: (str(r[0]), r[1], r[2], r[3], str(r[7] is None))
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(plain_quality(rows, trusted, quality.THRESHOLD), key=order), strict=True):
        assert g[:7] == w[:7] and g[8] == w[8]
        assert g[7] is w[7] is None or g[7] == pytest.approx(w[7], abs=1e-9)


def test_quality_beside_plain_counting(spark, make, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = defaultdict(list)
    for r in labels.collect():
        found[r.doc_id].append(r.quality == 1 and not r.toxic)
    check_quality(docs, labels, {k for k, v in found.items() if all(v)})
    odd = make([*ODD, (None, "no id " * 30), (3, "again"), (3, "again")], _words="x", n_words=1, quality=2)
    marks = spark.createDataFrame([(3, 1, 0), (6, 1, None), (7, 1, 1), (8, 0, 0), (9, None, 0), (3, 1, 0), (10, 1, 0), (10, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    check_quality(odd, marks, {3, 6})
    check_quality(odd, marks.limit(0), set())
    assert quality.quality_rules(odd.limit(0), marks).collect() == []


def test_quality_uses_no_python(docs, sf, spark):
    plan = quality.quality_rules(docs, spark.read.parquet(f"{sf}/labels.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def plain_mixture(rows, limit, seed="mix"):
    """Passes of every row, for the smallest budget that gives each source a whole pass."""
    tokens = [(i, s, len(WORD.findall(t or ""))) for i, t, s in rows]
    n = Counter()
    for _, s, k in tokens:
        n[s] += k
    positive = [x for x in n.values() if x]
    if not positive:
        return [(i, s, k, 1) for i, s, k in tokens]
    most, least = max(positive), min(positive)
    low, high = 0.0, 1.0
    if (least / most) ** -1.0 <= limit:
        high = 0.0
    for _ in range(32 if high else 0):
        mid = (low + high) / 2
        low, high = (low, mid) if (least / most) ** (mid - 1) <= limit else (mid, high)
    import hashlib

    place = lambda turn, i: hashlib.md5(f"{seed}:{turn}:{'' if i is None else i}".encode()).hexdigest()
    out = []
    for source in n:
        own = [t for t in tokens if t[1] == source]
        whole, rest = divmod(math.floor(n[source] * (n[source] / most) ** (high - 1)), n[source]) if n[source] else (1, 0)
        cost = Counter()
        for i, _, k in own:
            cost[place(whole, i)] += k
        taken, total = set(), 0
        for p in sorted(cost):
            total += cost[p]
            if total > rest:
                break
            taken.add(p)
        out += [(i, s, k, whole + (rest > 0 and place(whole, i) in taken)) for i, s, k in own]
    return out


def test_mixing_beside_plain_choice(spark, docs):
    rng = random.Random(2)
    sources = ["hot"] * 8 + ["a", "b", "b", None]
    data = [(i, " ".join("w" * rng.randrange(0, 60)), rng.choice(sources)) for i in range(300)]
    data += [(7, "same row", "b"), (7, "same row", "b"), (None, "no id", "a"), (None, None, "a"), (400, None, "empty"), (401, "", "empty"), (402, "z " * 5000, "long")]
    odd = spark.createDataFrame([(i, t, s, "k", 1) for i, t, s in data], "doc_id long, text string, source string, pass string, _n int")
    for df, limit in ((odd, 2.0), (odd, 3.7), (odd, 1e9), (docs, 2.0)):
        rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
        want = Counter()
        for i, s, k, passes in plain_mixture(rows, limit):
            want.update((i, s, k, p) for p in range(passes))
        got = mixing.mix(df, max_repeats=limit).collect()
        assert Counter((r.doc_id, r.source, r.n_tokens, r["pass"]) for r in got) == want
    assert mixing.mix(odd.limit(0), max_repeats=2.0).collect() == []


def test_mixing_to_an_entropy_and_a_budget(spark):
    df = spark.createDataFrame([(i, "w w w w", "abcd"[min(3, i % 10)]) for i in range(400)], "doc_id long, text string, source string")
    n = Counter("abcd"[min(3, i % 10)] for i in range(400))
    _, sources = mixing.mix_plan(df, target_entropy=1.3, budget=3000)
    weights = {r._of: r._weight for r in sources.collect()}
    assert -sum(w * math.log(w) for w in weights.values()) == pytest.approx(1.3, abs=1e-6)
    a = math.log(weights["a"] / weights["d"]) / math.log(n["a"] / n["d"])
    assert weights["b"] / weights["d"] == pytest.approx((n["b"] / n["d"]) ** a)
    total = Counter()
    for r in mixing.mix(df, target_entropy=1.3, budget=3000).collect():
        total[r.source] += r.n_tokens
    assert all(3000 * weights[s] - 4 <= total[s] <= 3000 * weights[s] for s in weights)
    small = Counter(r.source for r in mixing.mix(df, target_entropy=1.3, budget=100).collect())
    assert all(100 * weights[s] - 4 <= 4 * small[s] <= 100 * weights[s] for s in weights)
    _, repeated = mixing.mix_plan(df, max_repeats=2.0, budget=1600)
    assert max(r._weight * 1600 / (4 * n[r._of]) for r in repeated.collect()) <= 2.0


def test_mixing_repeats_documents_whole(spark, make):
    df = make(["a b", "c d e", None]).withColumn("source", F.when(F.col("doc_id") == 0, "x").otherwise("y")).withColumn("_key", F.lit("k"))
    _, sources = mixing.mix_plan(df, max_repeats=1.5)
    out = mixing.realise(df, sources)
    assert out.columns == df.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def segmentations(chunk, model, langs):
    pieces, _ = langid.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    if not chunk:
        return np.ones(langs)
    out = np.zeros(langs)
    for k in range(1, len(chunk) + 1):
        row = pieces.get(chunk[:k], len(pieces) if k == 1 else None)
        if row is not None:
            out = out + model[row] * segmentations(chunk[k:], model, langs)
    return out


def plain_forward(word, model):
    """The forward sum in exact fractions of the model's numbers: no cut, no rescaling."""
    pieces, _ = langid.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    alpha = [[Fraction(1)] * model.shape[1]] + [[Fraction(0)] * model.shape[1] for _ in word]
    for i in range(len(word)):
        for j in range(i + 1, len(word) + 1):
            row = pieces.get(word[i:j], len(pieces) if j == i + 1 else None)
            if row is not None:
                alpha[j] = [a + b * Fraction(p) for a, b, p in zip(alpha[j], alpha[i], model[row])]
    return [math.log(a.numerator) - math.log(a.denominator) for a in alpha[-1]]


@pytest.fixture(scope="module")
def random_model():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return path, np.random.default_rng(0).random((len(langid.vocabulary(path)[0]) + 1, 3)) * 1e-3


def test_forward_sum_equals_all_segmentations(random_model):
    path, model = random_model
    words = ["▁the", "▁", "tion", "▁übung", "▁日本x", "ñandú", "▁aaaaaaa"]
    got = langid.score_words(words, model, path)
    for row, c in zip(got, words):
        assert np.exp(row) == pytest.approx(segmentations(c, model, 3))


def test_forward_sum_of_long_words(random_model, monkeypatch):
    """Words of 25 to 60 letters and far longer, together and alone."""
    path, model = random_model
    letters = np.random.default_rng(2)
    words = ["▁" + "".join(letters.choice(list("theraionsd日é"), n)) for n in (24, 25, 26, 31, 40, 47, 60, 130)] + ["▁donaudampfschifffahrtsgesellschaftskapitaen", "▁a"]
    for at_once in (1 << 17, 50, 1):
        monkeypatch.setattr(langid, "LETTERS_AT_ONCE", at_once)
        for row, w in zip(langid.score_words(words, model, path), words):
            assert row == pytest.approx(plain_forward(w, model), rel=1e-12)
    long = "▁" + "international" * 5_000
    assert np.isfinite(langid.score_words([long], model, path)).all()


def test_expected_pieces_of_long_words(random_model, monkeypatch):
    """Expected counts are the derivative of the log probability by the log of a piece's probability."""
    path, model = random_model
    words, lang, times = ["▁theinternationalrelationsofthese", "▁on", "▁therationanderationsonthesead" * 2], np.array([0, 1, 2]), np.array([1, 3, 2])
    for at_once in (1 << 17, 3):
        monkeypatch.setattr(langid, "LETTERS_AT_ONCE", at_once)
        got = defaultdict(float)
        for found, of, share in langid.expected_pieces(words, lang, times, model, path):
            for p, k, x in zip(found, of, share):
                got[int(p), int(k)] += x
        for (p, k), x in sorted(got.items())[::7]:
            step, sums = 1e-4, []
            for sign in (1, -1):
                moved = model.copy()
                moved[p, k] *= np.exp(sign * step)
                sums.append(sum(t * langid.score_words([w], moved, path)[0, k] for w, g, t in zip(words, lang, times) if g == k))
            assert x == pytest.approx((sums[0] - sums[1]) / (2 * step), rel=1e-4, abs=1e-6)
        letters = sum(x * len(next(w for w, i in langid.vocabulary(path)[0].items() if i == p)) for (p, k), x in got.items())
        assert letters == pytest.approx(sum(len(w) * t for w, t in zip(words, times)))


def test_words_keep_every_letter():
    words = langid.words_of("Short " + "x" * 60 + " 12 a_b ÉÀ")
    assert words == ["▁short", "▁" + "x" * 60, "▁a", "▁b", "▁éà"]


def test_language_accuracy_on_documents_not_learned(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.train_and_identify(df).join(df.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    assert {r.doc_id: r.held_out for r in got} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got}
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.truth for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_documents(spark, make, docs):
    langs, model = langid.train(docs)
    assert langs == ["de", "en", "es", "fr"]
    odd = make([None, "", "123 !? _", "and the of", "AND\x00the", "日本語" * 20_000, (None, "der die und"), (3, "and the of")], lang_pred=1, _0="x", score="y")
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in langid.identify(odd, langs, model).collect()), key=str)
    assert {(r[0], r[1]) for r in got} >= {(0, "und"), (1, "und"), (2, "und"), (3, "en"), (4, "en"), (None, "de")} and len(got) == 8
    assert all((r[2] == 0.0) == (r[1] == "und") for r in got)
    kept = langid.keep_identified(odd, langs, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {3, 4, None} and not {r.doc_id for r in kept.collect()} & {0, 1, 2}
    none, empty = langid.train(docs.limit(0))
    assert none == [] and {r.lang_pred for r in langid.identify(odd, none, empty).collect()} == {"und"}
    assert langid.identify(odd.limit(0), langs, model).collect() == []
    assert langid.train(make(["x"]).withColumn("lang", F.lit(None).cast("string")))[0] == []


@pytest.mark.parametrize("key", sorted(queries.CHECKS))
def test_queries_beside_their_sql(spark, key):
    from workload.check import compare, connect

    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), sf, queries.QUERIES[key], queries.CHECKS[key]) == ""


def test_contract_columns(spark, sf):
    want = {
        "op2_token_counts": "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
        "op3_secret_scans": "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
        "op5_quality_rules": "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean",
        "op8_jaccard_join": "doc_id long, n_shingles long, component_id long",
        "op9_best_fit_packing": "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        "op10_language_id": "doc_id long, held_out boolean, lang_pred string, score double",
    }
    names = {"bigint": "long"}
    for key, columns in want.items():
        types = {c: names.get(t, t) for c, t in queries.QUERIES[key](spark, sf).dtypes}
        assert {c: t for c, t in (x.split(" ") for x in columns.split(", "))}.items() <= types.items(), key


