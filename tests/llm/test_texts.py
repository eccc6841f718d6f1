"""Secret scan, token counts and packing beside the plain definitions."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from carelens.llm import packing, secret_scan, token_counts

TEXTS = [
    None, "", " ", "\n", "a", "  a  b ", "a\n\nb\n c", "▁▁x ▁ y▁", "tab\there\r\nand", "<s>hi</s> <0x0A>", "<|endoftext|> it's <|startoftext|>x don't", "ÀÉ é ﬁ İ ǅ Σς",
    "a\u00a0b\u2003c\u0085d\x1ce\x0bf", "名前は 日本語🙂👩‍👩‍👧", "e\u0301 \u0301x", "\x00nul\x00", "x" * 3000, "word " * 9000, "a\n" * 5000, "same", "same",
    'password="abcdefghijkl" Token : xyz.123/456=_+-ABC', "secretoken=abcdefghijklmno", "password: token: abcdefghijklmnop", "AKIA1234567890ABCD AKIAAKIA12345678901", "AKIA",
    "deadbeef" * 2 + " " + "deadbeef" + " é🙂 " + "0123456789abcdef0", "ſecret=abcdefghijklmnop to\u212aen=abcdefghijklmnop", "API_KEY='ABCDEFGHIJKLMNOP' apikey=short api__key=abcdefghijklmn",
]

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def plain_spans(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def as_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWd", "secret", "token", "api_key", "apikey", "AKIA", "AKI", "0123456789ABCD", "=", ":", " ", '"', "'", "abcdef012345", "é", "🙂", "\n", "t", "."]), max_size=25))
def test_spans_equal_a_whole_search(parts):
    text = "".join(parts)
    assert [s for s in secret_scan.find_spans(text) if s[0] in secret_scan.BASE] == plain_spans(text)


def test_checked_tokens_and_masks():
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    good = f"ghp_{body}{secret_scan.checksum(body)}"
    bad = good[:-1] + ("x" if good[-1] != "x" else "y")
    assert secret_scan.find_spans(f"é {good} {bad} x{good} {good}z") == [("github", 2, 2 + len(good))]
    text = f'é token="{good}" end'
    assert secret_scan.mask(text, secret_scan.find_spans(text)) == 'é [secret]" end'


def test_scan_beside_plain_search(spark, make, docs):
    for df in (make(TEXTS, spans="x", base_sha256=1), docs):
        got = {r.doc_id: r for r in secret_scan.scan_digest(secret_scan.scan_secrets(df)).collect()}
        for r in df.collect():
            spans, g = plain_spans(r.text or ""), got[r.doc_id]
            assert (g.n_assign, g.n_access, g.n_hex) == tuple(sum(s[0] == k for s in spans) for k in secret_scan.BASE)
            assert g.base_sha256 == hashlib.sha256(as_text(spans).encode()).hexdigest()
            assert [s for s in g.spans.split(",") if s and s.split(":")[0] in secret_scan.BASE] == [f"{k}:{a}:{b}" for k, a, b in spans]
    assert secret_scan.scan_secrets(docs.limit(0)).collect() == []


def test_masking_keeps_columns(spark, make):
    df = make([(None, "token=abcdefghijklmnop x"), (1, None), (1, "clean"), (1, "clean")], _0="k", spans=2)
    got = sorted(map(str, secret_scan.mask_secrets(df).collect()))
    want = [r if r.text != "token=abcdefghijklmnop x" else type(r)(**{**r.asDict(), "text": "[secret] x"}) for r in df.collect()]
    assert got == sorted(map(str, want)) and secret_scan.mask_secrets(df).columns == df.columns


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list(" \n▁\t\r ab.;)é日🙂\u00a0\x00")), max_size=30))
def test_pretoken_lengths_add_up(library, text):
    parts = token_counts.pretokens(text.encode())
    assert sum(token_counts.pretoken_length(library, p) for p in parts) == len(library.encode(text))


def test_no_vocabulary_piece_spans_a_cut(library):
    for i in range(library.vocab_size()):
        p = library.id_to_piece(i)
        assert library.is_byte(i) or ("▁" not in p.lstrip("▁") and "\n" not in p)


def test_token_counts_beside_the_library(spark, make, docs, library, monkeypatch):
    for df in (make(TEXTS, n_tokens="x", n_bytes=1), docs):
        want = sorted((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "")), len(library.encode(r.text or "")) > 4096) for r in df.collect())
        assert sorted(tuple(r) for r in token_counts.count_tokens(df).collect()) == want
    assert token_counts.count_tokens(docs.limit(0)).collect() == []


def test_long_pretokens_stay_out_of_the_table(spark, make, library, monkeypatch):
    texts = ["日本語" * 30_000 + " short short", "日本語" * 30_000 + " short", "x" * 64 + " " + "y" * 65, "x" * 64 + " " + "y" * 65]
    token_counts.ship(spark)
    blob, ends, lengths = token_counts.frequent_pretokens(make(texts).coalesce(1).select("text"), public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted(blob[s:e] for s, e in zip([0, *ends[:-1]], ends)) == [b"short", b"x" * 64] and len(lengths) == 2
    want = [(i, len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 4096) for i, t in enumerate(texts)]
    assert sorted(tuple(r) for r in token_counts.count_tokens(make(texts)).collect()) == want
    monkeypatch.setattr(token_counts, "CACHED_BYTES", 100)
    table = token_counts._Lengths({}, library)
    for n in (60, 60, 90, 40, 101, 10):
        assert table[b"z" * n] == token_counts.pretoken_length(library, b"z" * n)
        assert sum(map(len, table.rare)) == table.size <= 100


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*" \n\t\x0b\x0c\x1c\u0085\u00a0\u2003'sStTÉée\u0301ΣσİIﬁ1२日🙂.,<|>\x00", "<|endoftext|>", "<|ENDOFTEXT|>", "it's.", "...", "a,", "\u212a"]), max_size=30).map("".join))
def test_ids_of_words_are_ids_of_the_text(word_tokenizer, text):
    [ids] = packing.encode(pa.array([text]), public_tokenizers.path("word_bpe_49k.json"), 1)
    assert np.frombuffer(ids, "<u4").tolist() == word_tokenizer.encode(text, add_special_tokens=False).ids + [1]


def check_packing(df, packed, tokenizer, size):
    want = defaultdict(list)
    for r in df.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        for p in range(0, len(ids), size):
            want[r.doc_id].append((p // size, p, len(ids[p : p + size]), zlib.crc32(ids[p : p + size].tobytes())))
    got, sequences = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    total = sum(x[2] for v in want.values() for x in v)
    return len(sequences), -(-total // size)


def test_packing_given_documents(docs, word_tokenizer):
    used, least = check_packing(docs, packing.pack(docs), word_tokenizer, 4096)
    assert used <= least * 1.02 + 1


def test_packing_odd_documents(spark, make, word_tokenizer):
    df = make([*TEXTS, (None, "no id"), (None, None), *[(1000 + i, "same length text") for i in range(60)]], length="x", sequence_id=1, _rank=2)
    used, least = check_packing(df, packing.pack(df, size=16), word_tokenizer, 16)
    assert used <= least * 1.05 + 1
    assert packing.pack(df.limit(0)).collect() == []
    ids = {r.doc_id: r.ids for r in packing.pack(make(["a b"]), with_ids=True).collect()}
    assert np.frombuffer(ids[0], "<u4").tolist() == word_tokenizer.encode("a b", add_special_tokens=False).ids + [1]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 30), max_size=8), st.integers(0, 40))
def test_fullest_combination(counts, room):
    reach = {0}
    for x, n in counts.items():
        reach = {r + x * k for r in reach for k in range(n + 1) if r + x * k <= room}
    taken = packing.fullest(counts, room)
    assert sum(x * n for x, n in taken.items()) == max(reach) and all(0 < n <= counts[x] for x, n in taken.items())


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 1000), max_size=12))
def test_plan_places_every_length_once(counts):
    placed = defaultdict(int)
    for pattern, bins in packing.plan(counts, 20):
        assert sum(x * n for x, n in pattern.items()) <= 20
        for x, n in pattern.items():
            placed[x] += n * bins
    assert dict(placed) == counts


def test_workers_forget_what_other_operators_keep():
    from carelens.llm import common

    kept = {"a": [1], "b": [2]}
    common.enter("test a", kept["a"].clear)
    common.enter("test a", kept["a"].clear)
    assert kept["a"] == [1]
    common.enter("test b", kept["b"].clear)
    assert kept == {"a": [], "b": [2]}
    common.enter("test c")
    assert kept == {"a": [], "b": []} and not common._kept
