"""Secrets in texts: keywords by one automaton, anchored expressions at its hits, embedded checksums last."""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import enter, parts, ship

# What secrets look like.
KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a shorter run never holds a longer one
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
CHECKED_PREFIXES = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ["assign", "access", "hex", "github", "npm"]
BASE = KINDS[:3]

SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
SPANS_DDL = "array<struct<kind: string, start: int, end: int>>"
MASK = "[secret]"


@cache
def _automaton() -> ahocorasick.Automaton:
    """Keywords in every mix of cases, so that texts need no lower-casing (which can move positions)."""
    found = ahocorasick.Automaton()
    for word in KEYWORDS:
        for letters in itertools.product(*({c.lower(), c.upper()} for c in word)):
            found.add_word("".join(letters), ("assign", len(word)))
    found.add_word("AKIA", ("access", 4))
    for prefix, kind in CHECKED_PREFIXES.items():
        found.add_word(prefix, (kind, len(prefix)))
    found.make_automaton()
    return found


def checksum(body: str) -> str:
    """CRC-32 of a token's body in six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind in the order of KINDS."""
    spans, after = [], dict.fromkeys(KINDS, 0)
    for last, (kind, size) in _automaton().iter(text):
        start = last - size + 1
        if start < after[kind]:  # within an earlier match of the kind
            continue
        if kind == "assign":
            if m := ASSIGN.match(text, start):
                after[kind] = m.end()
                if m.end() - m.start(1) >= 12:
                    spans.append((kind, start, m.end()))
        elif kind == "access":
            if m := ACCESS.match(text, start):
                after[kind] = m.end()
                if m.end() - start >= 18:
                    spans.append((kind, start, m.end()))
        elif (m := CHECKED.match(text, start)) and not (start and (text[start - 1].isalnum() or text[start - 1] == "_")):
            after[kind] = m.end()
            if checksum(m[1]) == m[2]:
                spans.append((kind, start, m.end()))
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every secret replaced; overlapping spans become one mask."""
    out, done = [], 0
    for _, start, end in spans:
        if start >= done:
            out += [text[done:start], MASK]
        done = max(done, end)
    return "".join(out) + text[done:] if out else text


def _scan(batches: Iterator[pa.RecordBatch], text: int, masked: bool) -> Iterator[pa.RecordBatch]:
    enter("secret_scan")
    for b in (part for whole in batches for part in parts(whole, text)):
        texts = b.column(text).to_pylist()
        found = [find_spans(t) if t else [] for t in texts]
        columns, names = list(b.columns), list(b.schema.names)
        if masked:
            columns[text] = pa.array([mask(t, s) if s else t for t, s in zip(texts, found)], pa.string())
        else:
            del columns[text], names[text]
        spans = pa.array([[{"kind": k, "start": i, "end": j} for k, i, j in s] for s in found], SPANS)
        yield pa.RecordBatch.from_arrays([*columns, spans], [*names, "_spans"])


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Secrets of every whole text: the key, and ``spans``, an array of kind, start and end (code points, end exclusive).

    Base kinds, leftmost without overlap within a kind: ``assign`` (a keyword in either case, a sign, a value of 12
    characters or more), ``access`` (AKIA and capitals or digits, 18 characters or more), ``hex`` (16 characters or
    more).  The automaton finds the keywords; expressions are tried only where it hits, and only after the end of
    the kind's last match, which gives the matches a search of the whole text gives.  ``hex`` has no keyword and is
    searched by its characters.  Added kinds, ``github`` and ``npm``, are tokens whose last six characters are the
    checksum of the body.

    A missing or empty text has no spans, a missing key stays; repeated rows give repeated rows; an empty table gives
    an empty result; other columns are ignored.  Rows are independent: nothing is shuffled.
    """
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    scanned = rows.mapInArrow(lambda it: _scan(it, 1, False), f"_key {kind}, _spans {SPANS_DDL}")
    return scanned.select(F.col("_key").alias(key), F.col("_spans").alias("spans"))


def mask_secrets(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """The same rows and columns with every secret in ``text`` replaced by a mask; other texts are untouched.

    ``length`` names a column with the number of characters, to be counted again where a text changes.
    """
    ship(docs.sparkSession)
    names = [f"_{i}" for i in range(len(docs.columns))]
    rows, at = docs.toDF(*names), docs.columns.index(text)
    schema = ", ".join(f"{n} {t}" for n, (_, t) in zip(names, rows.dtypes))
    out = rows.mapInArrow(lambda it: _scan(it, at, True), f"{schema}, _spans {SPANS_DDL}")
    if length is not None:
        n = names[docs.columns.index(length)]
        out = out.withColumn(n, F.when(F.size("_spans") > 0, F.length(names[at])).otherwise(F.col(n)).cast(dict(docs.dtypes)[length]))
    return out.drop("_spans").toDF(*docs.columns)


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, SHA-256 of their spans as text, and all spans as text."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(BASE))
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select(key, *[count(k) for k in BASE], F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(spans).alias("spans"))
