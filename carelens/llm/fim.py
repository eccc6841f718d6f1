"""Fill-in-the-middle: texts cut at units and put together in another order, and back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import parts, ship

BLOCK = 1 << 12  # code points of a text block
MARKS = ("<P>", "<S>", "<M>")  # of prefix, suffix and middle
PLAIN, PSM, SPM = "plain", "psm", "spm"
CUT = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]


def unit_starts(text: str, start: int, end: int) -> np.ndarray:
    """Where units start among the code points from ``start`` to ``end``, counted from ``start``.

    A unit is a run of letters A-Z of either case, or any other single code point; so one starts at every code point
    but a letter that follows a letter.
    """
    before = max(start - 1, 0)
    points = np.frombuffer(text[before:end].encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (points | 32) - np.uint32(97) < 26
    begins = ~letter
    begins[1:] |= ~letter[:-1]
    if start == 0:
        begins[:1] = True
    return np.flatnonzero(begins[start - before :])


class UnitTree:
    """A Fenwick tree over the fixed blocks of a text: how many units start in them, and how many code points they have."""

    def __init__(self, text: str):
        self.text = text
        self.blocks = -(-len(text) // BLOCK)
        self.units, self.points = [0] * (self.blocks + 1), [0] * (self.blocks + 1)
        for i in range(1, self.blocks + 1):
            start, end = (i - 1) * BLOCK, min(i * BLOCK, len(text))
            self.units[i] += len(unit_starts(text, start, end))
            self.points[i] += end - start
            above = i + (i & -i)
            if above <= self.blocks:
                self.units[above] += self.units[i]
                self.points[above] += self.points[i]
        self.total = self._sum(self.blocks)

    def _sum(self, i: int) -> int:
        n = 0
        while i:
            n += self.units[i]
            i &= i - 1
        return n

    def place_after(self, units: int) -> int:
        """Code points that the first ``units`` units have: down the tree to the block, then within the block."""
        if units >= self.total:
            return len(self.text)
        at = passed = points = 0
        step = 1 << self.blocks.bit_length()
        while step := step >> 1:
            if at + step <= self.blocks and passed + self.units[at + step] <= units:
                at += step
                passed += self.units[at]
                points += self.points[at]
        return points + int(unit_starts(self.text, points, min(points + BLOCK, len(self.text)))[units - passed])


def draws(key: str, seed: int) -> list[int]:
    """Four numbers from the SHA-256 of the seed and the key as text."""
    found = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(found[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str, key: str, seed: int, percent: int, spm_percent: int) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle (None when plain), and the text in its new order."""
    tree = UnitTree(text)
    n = tree.total
    h1, h2, h3, h4 = draws(key, seed)
    if not text or h3 % 100 >= percent or any(m in text for m in MARKS):
        return n, PLAIN, None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = tree.place_after(low), tree.place_after(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if h4 % 100 < spm_percent:
        return n, SPM, a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, PSM, a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def _transform(batches: Iterator[pa.RecordBatch], seed: int, percent: int, spm_percent: int) -> Iterator[pa.RecordBatch]:
    for b in (part for whole in batches for part in parts(whole, 2)):
        found = [transform(t, k, seed, percent, spm_percent) for k, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(c, t) for c, (_, t) in zip(zip(*found), CUT))], ["_key", *(name for name, _ in CUT)]
        )


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, percent: int = 90, spm_percent: int = 20
) -> DataFrame:
    """Per row: the key, n (units), form, prefix_chars, middle_chars and ``output``, the text in its new order.

    Two cuts are drawn from the SHA-256 of ``seed:key``: prefix, middle and suffix have whole units.  ``psm`` is the mark
    <P>, prefix, <S>, suffix, <M>, middle; ``spm`` has <S> and suffix first.  Of all rows ``percent`` in a hundred are
    changed, of these ``spm_percent`` in a hundred to ``spm``.  A tree over blocks of 4,096 code points is searched down
    for each cut, so a text is scanned once and each cut costs a block.

    Texts that are empty or hold one of the marks are ``plain``: output is the text, prefix_chars and middle_chars are
    null.  A missing text is empty; a missing key draws as an empty one and stays; repeated rows give repeated rows;
    an empty table gives an empty result; other columns are ignored.
    """
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_name"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    cut = rows.mapInArrow(
        lambda it: _transform(it, seed, percent, spm_percent),
        f"_key {kind}, n long, form string, prefix_chars long, middle_chars long, output string",
    )
    return cut.withColumnRenamed("_key", key)


def restore(output: Column, form: Column) -> Column:
    """The text that was changed: the marks stand once in every output that is not plain."""
    p, s, m = MARKS

    def part(begin: str, end: str | None) -> Column:
        rest = F.substring_index(output, begin, -1)
        return rest if end is None else F.substring_index(rest, end, 1)

    return (
        F.when(form == PSM, F.concat(part(p, s), part(m, None), part(s, m)))
        .when(form == SPM, F.concat(part(p, m), part(m, None), part(s, p)))
        .otherwise(output)
    )
