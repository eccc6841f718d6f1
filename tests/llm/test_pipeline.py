"""Each stage on all its predecessor kept, beside plain versions; odd documents go through the whole pipeline."""

import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from carelens.llm import langid
from tests.llm.test_jaccard import edited, plain
from tests.llm.test_models import plain_mixture
from tests.llm.test_texts import check_packing, plain_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The given documents and each stage's result."""
    root, out = tmp_path_factory.mktemp("stages"), [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        step(spark, out[-1], SF).write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "secret_scans", "source_mixing", "best_fit_packing"]


def test_language_stage_drops_only_texts_without_language(stages):
    before, after = ({tuple(r) for r in s.collect()} for s in stages[:2])
    assert after <= before
    assert all(not langid.words_of(r[1]) for r in before - after)


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(i for i, _, c in plain(rows) if i == c)


def test_secrets_are_masked(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    changed = {i for i in before if before[i].text != after[i].text}
    assert changed == {i for i in before if plain_spans(before[i].text or "")}
    assert not any(plain_spans(r.text or "") for r in after.values())
    assert all(r.n_chars == len(r.text) for i, r in after.items() if i in changed)


def test_mixture_has_every_document(stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[3].collect()]
    want = Counter()
    for i, _, _, passes in plain_mixture(rows, corpus_pipeline.MAX_REPEATS):
        want[i] += passes
    assert Counter(r.doc_id for r in stages[4].collect()) == want and min(want.values()) >= 1


def test_sequences(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    used, least = check_packing(stages[4], stages[5], tokenizer, 4096)
    assert used <= least * 1.02 + 1


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, got.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(map(str, stages[5].select("doc_id", "piece", "length", "ids_crc32").collect()))


def test_odd_documents(spark, tmp_path):
    import random

    rng = random.Random(4)
    words = "the of and to in that is was for with on as by at from this be it are or".split()
    base = [rng.choice(words) + rng.choice(["", "er", "ing"]) for _ in range(120)]
    data = [(i, edited(rng, base, 1), "en", "hot" if i % 2 else None, 5) for i in range(30)]
    data += [(40, None, "en", "s", None), (41, "", None, "s", 0), (42, "!!! 123", "fr", "s", 7), (None, "the words without id", "en", "s", 1), (None, "the words without id", "en", "s", 1),
             (43, "the same id", None, "t", 1), (43, "the same id", None, "t", 1), (43, "of another text here", "en", "t", 1), (44, "the token=abcdefghijklmnop is", "en", "t", 29),
             (45, "der die und das " * 9000, "de", "long", 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "doc_id long, text string, lang string, source string, n_chars long, _pred string, component_id int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(Counter(r.doc_id for r in docs.collect()))
    assert {40, 41, 42}.isdisjoint(kept[0]) and kept[0][None] == 2 and kept[0][43] == 3
    assert kept[1][43] == 1 and kept[1][None] == 2 and 0 in kept[1] and sum(n for i, n in kept[1].items() if i is not None and i < 30) == 1
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text)
    assert re.fullmatch(r"the \[secret\] is", texts[44][0])
    corpus_pipeline.run(spark, str(tmp_path)).collect()
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
