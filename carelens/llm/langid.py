"""Language of texts by unigram models over a public vocabulary, summing over all segmentations."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import batch, enter, parts, ship
from carelens.sources.staging import stage

SAMPLE = 4_000  # training documents of a language, about; the only bound, and only on what the models learn from
ROUNDS = 3  # of expectation and maximisation
UNIT = 2.0**20  # expected counts are added up in whole units, so that no order of addition matters
SMOOTHING = 0.1  # added to the expected count of every piece
OUTSIDE = 1e-7  # probability of a letter that the vocabulary lacks, the same in every language
AT_ONCE = 4096  # words worked on together
LETTERS_AT_ONCE = 1 << 17  # letters, all words as long as the longest
CACHED = 300_000  # words a worker remembers with their scores
CACHED_LETTERS = 8 << 20  # letters of them
UNKNOWN = "und"

LETTERS = re.compile(r"[^\W\d_]+")
START = "▁"
WORDS = pa.schema([("lang", pa.int32()), ("word", pa.string()), ("n", pa.int64())])
EXPECTED = pa.schema([("lang", pa.int32()), ("piece", pa.int32()), ("units", pa.int64())])


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased, whole, behind a start sign; marks, digits and signs are the same in all languages and left out."""
    return [START + w for w in LETTERS.findall(text.lower())] if text else []


@cache
def vocabulary(path: str) -> tuple[dict[str, int], set[str]]:
    """Pieces of lower-case letters, with or without start sign, and all their beginnings."""
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (library.id_to_piece(i) for i in range(library.vocab_size()) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i)))
    own = sorted({p for p in pieces if p == p.lower() and (p == START or p.removeprefix(START).isalpha())} | {START})
    return {p: i for i, p in enumerate(own)}, {p[:n] for p in own for n in range(1, len(p) + 1)}


def _batches(words: list[str]) -> Iterator[np.ndarray]:
    """Numbers of words to work on together, the longest first: of bounded number and letters, but for one very long word."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    start = 0
    while start < len(order):
        most = max(1, min(AT_ONCE, LETTERS_AT_ONCE // len(words[order[start]])))
        yield np.array(order[start : start + most])
        start += most


def _edges(words: list[str], i: int, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, length and piece of every piece that starts at letter ``i`` of a word; a letter alone always does."""
    pieces, beginnings = vocabulary(path)
    outside = len(pieces)
    rows, spans, found = [], [], []
    for r, word in enumerate(words):
        size = len(word)
        if size <= i:  # the longest come first
            break
        rows.append(r), spans.append(1), found.append(pieces.get(word[i], outside))
        for j in range(i + 2, size + 1):
            part = word[i:j]
            if part not in beginnings:
                break
            if part in pieces:
                rows.append(r), spans.append(j - i), found.append(pieces[part])
    return np.array(rows, np.int64), np.array(spans, np.int64), np.array(found, np.int64)


@cache
def _ring(path: str) -> int:
    """Letters that a piece can reach ahead, and the place itself."""
    return max(map(len, vocabulary(path)[0])) + 1


def score_words(words: list[str], model: np.ndarray, path: str) -> np.ndarray:
    """Log probability of each word in each language, summed over all its segmentations; ``model`` has a row per piece and one for letters outside.

    The probability of a beginning of a word is needed until the longest piece has passed it, so a ring of that length
    holds for words of any length.  Its values are relative to the present place, whose logarithm is kept apart.
    """
    out, size = np.zeros((len(words), model.shape[1])), _ring(path)
    for at in _batches(words):
        own = [words[i] for i in at]
        lengths = np.array([len(w) for w in own])
        ring = np.zeros((len(own), size, model.shape[1]))
        ring[:, 0] = 1.0
        logs = np.zeros((len(own), model.shape[1]))
        for i in range(lengths[0]):
            n = int(np.searchsorted(-lengths, -i, side="left"))  # words that go on here
            rows, spans, found = _edges(own, i, path)
            ring[rows, (i + spans) % size] += model[found]
            ring[:n, i % size] = 0.0
            here = ring[:n, (i + 1) % size]
            logs[:n] += np.log(here)
            ring[:n] /= here[:, None, :].copy()
        out[at] = logs
    return out


def expected_pieces(words: list[str], lang: np.ndarray, times: np.ndarray, model: np.ndarray, path: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Piece, language and expected occurrences among all segmentations of the words, each in its language and so many times.

    Forward as in scoring, keeping the logarithm at every letter, then backward with a ring of its own.
    """
    size = _ring(path)
    for at in _batches(words):
        own, langs, n_times = [words[i] for i in at], lang[at], times[at]
        lengths = np.array([len(w) for w in own])
        steps = lengths[0]
        few = int(lengths.sum()) <= LETTERS_AT_ONCE
        kept = [_edges(own, i, path) for i in range(steps)] if few else None  # of a very long word they are found again
        edges = kept.__getitem__ if few else lambda i: _edges(own, i, path)  # noqa: B023
        going = [int(np.searchsorted(-lengths, -i, side="left")) for i in range(steps)]
        ring, logs = np.zeros((len(own), size)), np.zeros((len(own), steps + 1))
        ring[:, 0] = 1.0
        for i, n in enumerate(going):
            rows, spans, found = edges(i)
            ring[rows, (i + spans) % size] += model[found, langs[rows]]
            ring[:n, i % size] = 0.0
            here = ring[:n, (i + 1) % size].copy()
            logs[:n, i + 1] = logs[:n, i] + np.log(here)
            ring[:n] /= here[:, None]
        total = logs[np.arange(len(own)), lengths]
        ring, behind = np.zeros((len(own), size)), np.zeros(len(own))
        for i in range(steps - 1, -1, -1):
            n = going[i]
            ending = np.flatnonzero(lengths[:n] == i + 1)
            ring[ending, (i + 1) % size] = 1.0
            rows, spans, found = edges(i)
            through = model[found, langs[rows]] * ring[rows, (i + spans) % size]
            here = np.bincount(rows, through, minlength=n)
            behind[:n] += np.log(here)
            share = np.exp(logs[:n, i] + behind[:n] - total[:n])[rows] * through / here[rows]
            yield found, langs[rows], share * n_times[rows]
            ring[:n, i % size] = here  # the place that no piece from here on can reach
            ring[:n] /= here[:, None]


def _expect(batches: Iterator[pa.RecordBatch], model: np.ndarray, path: str) -> Iterator[pa.RecordBatch]:
    """Expected counts of pieces among the segmentations of each language's words."""
    units = np.zeros((len(vocabulary(path)[0]) + 1, model.shape[1]), np.int64)
    enter("langid", _scores.clear)
    for b in (part for whole in batches for part in parts(whole, 1, 8192)):
        langs, words, n = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist(), b.column(2).to_numpy(zero_copy_only=False)
        for piece, lang, times in expected_pieces(words, langs, n, model, path):
            np.add.at(units, (piece, lang), np.rint(times * UNIT).astype(np.int64))
    piece, lang = np.nonzero(units)
    if len(piece):
        yield batch(EXPECTED, lang.astype(np.int32), piece.astype(np.int32), units[piece, lang])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, Counter] = {}
    enter("langid", _scores.clear)
    for b in (part for whole in batches for part in parts(whole, 1)):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, counts.values())) > CACHED:
            for lang, own in counts.items():
                yield batch(WORDS, [lang] * len(own), list(own), list(own.values()))
            counts = {}
    for lang, own in counts.items():
        yield batch(WORDS, [lang] * len(own), list(own), list(own.values()))


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, vocab: str | None = None) -> tuple[list[str], np.ndarray]:
    """Languages, and a model: a row per piece and one for letters outside, a column per language.

    Learns from all labelled rows of a language with up to about ``sample`` of them, else from those whose hashed key
    falls under the share that gives as many.  Probabilities start equal and are re-estimated three times from the
    counts expected over all segmentations; words are counted first, so each different word is worked on once.
    Rows without key, text or language teach nothing.  The model is all the driver sees: pieces times languages.
    """
    spark = labelled.sparkSession
    ship(spark)
    path = vocab or public_tokenizers.path("piece_bpe_32k.model")
    rows = labelled.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).dropna()
    found = rows.groupBy("_lang").agg(F.count("*").alias("n")).orderBy("_lang").collect()  # a row per language
    langs = [r["_lang"] for r in found]
    size = len(vocabulary(path)[0])
    if not langs:
        return [], np.zeros((size + 1, 0))
    number = F.create_map(*[F.lit(x) for i, name in enumerate(langs) for x in (name, i)])[F.col("_lang")]
    share = F.create_map(*[F.lit(x) for r in found for x in (r["_lang"], min(1.0, sample / r["n"]))])[F.col("_lang")]
    chosen = rows.where(F.pmod(F.xxhash64(F.col("_key").cast("string")), F.lit(1 << 30)) < share * (1 << 30))
    counted = chosen.select(number.alias("lang"), "_text").mapInArrow(_count_words, "lang int, word string, n long")
    counted = stage(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    model = np.full((size + 1, len(langs)), 1.0 / size)
    model[size] = OUTSIDE
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)
        expected = counted.mapInArrow(lambda it: _expect(it, sent.value, path), "lang int, piece int, units long")
        sums = expected.groupBy("lang", "piece").agg(F.sum("units").alias("units")).toPandas()  # at most the model's size
        counts = np.full((size, len(langs)), SMOOTHING)
        inside = sums[sums["piece"] < size]
        counts[inside["piece"], inside["lang"]] += inside["units"] / UNIT
        model = np.vstack([counts / counts.sum(axis=0), np.full((1, len(langs)), OUTSIDE)])
        sent.unpersist()
    return langs, model


class _Scores:
    """Scores of words a worker has met: a number for each word, and a row of log probabilities for each number."""

    def __init__(self, model: np.ndarray, path: str):
        self.model, self.path = model, path
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.letters = 0
        self.rows = np.empty((4096, self.model.shape[1]))

    def learn(self, words: list[str]) -> None:
        base = len(self.number)
        while base + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[base : base + len(words)] = score_words(words, self.model, self.path)
        self.number.update(zip(words, range(base, base + len(words))))
        self.letters += sum(map(len, words))

    def make_room(self) -> None:
        if len(self.number) > CACHED or self.letters > CACHED_LETTERS:
            self.forget()


_scores: dict[str, _Scores] = {}


def _predict(batches, text: int, token: str, langs: list[str], model: np.ndarray, path: str) -> Iterator[pa.RecordBatch]:
    """The same batches with two more columns."""
    enter("langid", _scores.clear)
    if token not in _scores:
        _scores.clear()
        _scores[token] = _Scores(model, path)
    scores = _scores[token]
    for b in batches:
        pred, sure = [], []
        for part in parts(b, text, rows=256):
            words = [words_of(t) for t in part.column(text).to_pylist()]
            scores.make_room()
            scores.learn(sorted(set().union(*words).difference(scores.number)))
            for own in words:
                if not own or not langs:
                    pred.append(UNKNOWN), sure.append(0.0)
                    continue
                total = scores.rows[np.fromiter(map(scores.number.__getitem__, own), np.int64, len(own))].sum(axis=0)
                best = int(total.argmax())  # of equal ones the first by name
                pred.append(langs[best]), sure.append(round(1.0 / float(np.exp(total - total[best]).sum()), 9))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(sure, pa.float64())], [*b.schema.names, "_pred", "_score"])


def _identified(docs: DataFrame, text: str, langs: list[str], model: np.ndarray, vocab: str | None) -> DataFrame:
    """All columns by number, then _pred and _score."""
    spark = docs.sparkSession
    ship(spark)
    path = vocab or public_tokenizers.path("piece_bpe_32k.model")
    sent, token, at = spark.sparkContext.broadcast(model), uuid.uuid4().hex, docs.columns.index(text)
    rows = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(lambda it: _predict(it, at, token, langs, sent.value, path), f"{schema}, _pred string, _score double")


def identify(docs: DataFrame, langs: list[str], model: np.ndarray, key: str = "doc_id", text: str = "text", vocab: str | None = None) -> DataFrame:
    """Per row: the key, lang_pred and score, the probability of that language among all (equal ones before).

    Every whole text is scored: the sum over its words of the log of a word's probability, which the forward
    algorithm sums over all its segmentations into pieces.  A worker scores a word once and remembers it.
    A text that is missing or has no letter is ``und`` with score 0, as is everything when no language was learned.
    Of equally likely languages the first by name is taken.  A missing key stays; repeated rows give repeated rows; an
    empty table gives an empty result; other columns are ignored.
    """
    out = _identified(docs.select(key, text), text, langs, model, vocab)
    return out.select(F.col("_0").alias(key), F.col("_pred").alias("lang_pred"), F.col("_score").alias("score"))


def keep_identified(docs: DataFrame, langs: list[str], model: np.ndarray, least: float = 0.5, text: str = "text", vocab: str | None = None) -> DataFrame:
    """The documents, unchanged, whose language is one of the learned ones with a score of at least ``least``."""
    out = _identified(docs, text, langs, model, vocab).where((F.col("_pred") != UNKNOWN) & (F.col("_score") >= least))
    return out.drop("_pred", "_score").toDF(*docs.columns)


def held_out(key: Column) -> Column:
    """Documents no model learns from: a quarter, by the CRC-32 of the id as text; a missing id is not among them."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def train_and_identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the documents that are not held out, and predict all: key, held_out, lang_pred, score."""
    langs, model = train(docs.where(~held_out(F.col(key))), key, text, lang)
    return identify(docs, langs, model, key, text).select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score")
