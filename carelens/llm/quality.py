"""Quality rules and a likelihood ratio of hashed n-grams, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.sources.staging import stage

# Fixed values of the base rules.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
WORD = r"[^\x20\x09-\x0D]"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words within repeated windows

BUCKETS = 1 << 15  # of hashed n-grams, in each of the two models
SMOOTHING = 1.0  # added to the count of every bucket
TRUSTED = 50_000  # documents the target is learned from, about; the raw model counts all documents
THRESHOLD = -0.08  # nats per n-gram: on average a twelfth less likely as a trusted text than as any


def _parts(text: Column) -> Column:
    """The text cut at every white space character; searches for single bytes are much faster here than patterns."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.split(text, " ", -1)


def _from(array: Column, start: int) -> Column:
    return F.slice(array, start, F.greatest(F.size(array), F.lit(1)))


def _with_hashes(rows: DataFrame) -> DataFrame:
    """Add ``_words``, the hashes ``_ones`` of the words and ``_twos`` of each word with its follower (or the end).

    Each step is a column of its own: an expression within a function of array elements is evaluated anew each time.
    """
    rows = rows.withColumn("_words", F.array_remove("_parts", ""))
    rows = rows.withColumn("_ones", F.transform("_words", lambda w: F.xxhash64(w)))
    return rows.withColumn("_twos", F.zip_with("_ones", _from(F.col("_ones"), 2), lambda a, b: F.xxhash64(a, b)))


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``, the words within three-word windows that occur more than once.

    Without two windows of the same hash there are none.  Else the windows are sorted with their places, by hash, then
    by the words themselves; equal neighbours are the repeated ones.  Of the repeated places in order, each covers the
    words up to the next one, three at most.  Nothing is compared with everything.
    """
    n = F.greatest(F.size("_words") - 2, F.lit(0))
    rows = rows.withColumn("_threes", F.slice(F.zip_with("_twos", _from(F.col("_ones"), 3), lambda p, c: F.xxhash64(p, c)), 1, n))
    zipped = F.arrays_zip(F.col("_words").alias("a"), _from(F.col("_words"), 2).alias("b"), _from(F.col("_words"), 3).alias("c"))
    placed = F.transform(
        F.zip_with(F.slice(zipped, 1, n), "_threes", lambda r, h: F.struct(h.alias("h"), F.concat_ws(" ", r["a"], r["b"], r["c"]).alias("w"))),
        lambda x, i: F.struct(x["h"].alias("h"), x["w"].alias("w"), i.alias("i")),
    )
    several = F.size(F.array_distinct("_threes")) < F.size("_threes")
    rows = rows.withColumn("_placed", F.when(several, F.sort_array(placed)))
    same = F.filter(
        F.arrays_zip(F.col("_placed").alias("a"), _from(F.col("_placed"), 2).alias("b")),
        lambda r: (r["a"]["h"] == r["b"]["h"]) & (r["a"]["w"] == r["b"]["w"]),
    )
    rows = rows.withColumn("_same", F.transform(same, lambda r: F.struct(r["a"]["i"].alias("x"), r["b"]["i"].alias("y"))))
    marked = F.sort_array(F.array_distinct(F.concat(F.transform("_same", lambda r: r["x"]), F.transform("_same", lambda r: r["y"]))))
    covered = F.aggregate(
        marked, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def learn(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Log ratio of both models for every bucket: one row with the array ``ratios``.

    The raw model counts the n-grams of all documents, the target those of the trusted ones; both are combined in each
    task before anything is shuffled, so only counts by bucket are.  ``trusted`` (a column like ``key``, without
    repeats) is joined as it comes.
    """
    known = trusted.select(F.col(trusted.columns[0]).alias("_trusted"))
    rows = docs.select(F.col(key).alias("_key"), _parts(F.coalesce(F.col(text), F.lit(""))).alias("_parts"))
    rows = _with_hashes(rows.join(known, F.col("_key") == F.col("_trusted"), "left"))
    counted = (
        rows.select(F.explode(F.concat("_ones", "_twos")).alias("_h"), F.col("_trusted").isNotNull().cast("long").alias("_t"))
        .groupBy(F.pmod("_h", F.lit(BUCKETS)).alias("_b")).agg(F.count("*").alias("_raw"), F.sum("_t").alias("_target"))
    )
    spark = docs.sparkSession
    every = spark.range(0, BUCKETS, 1, 1).withColumnRenamed("id", "_bucket")  # the model's size, not the data's
    counts = stage(counted, "grams")
    sums = counts.agg(F.coalesce(F.sum("_raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("_target"), F.lit(0)).alias("target")).first()
    n = lambda c: F.coalesce(F.col(c), F.lit(0)) + F.lit(SMOOTHING)
    total = {k: float(sums[k]) + SMOOTHING * BUCKETS for k in ("raw", "target")}
    ratio = F.log(n("_target") / F.lit(total["target"])) - F.log(n("_raw") / F.lit(total["raw"]))
    per = every.join(counts, F.col("_bucket") == F.col("_b").cast("long"), "left").select("_bucket", ratio.alias("_r"))
    return stage(per.agg(F.transform(F.array_sort(F.collect_list(F.struct("_bucket", "_r"))), lambda x: x["_r"]).alias("ratios")), "ratios")


def trusted_documents(labels: DataFrame, bound: int = TRUSTED, key: str = "doc_id") -> DataFrame:
    """Documents labelled good and not toxic by all their labels; of more than ``bound``, a share as large, by hashed id."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    by_doc = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.coalesce(good, F.lit(False))).alias("_good"))
    found = stage(by_doc.where("_good").select(F.col(key).alias("_id")), "trusted")
    share = min(1.0, bound / max(1, found.count()))
    return F.broadcast(found.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < share * (1 << 30)))  # about the bound at most


def judge(docs: DataFrame, ratios: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept.

    ``llr`` is the mean over a document's words, alone and with their followers, of the log ratio of their buckets'
    probabilities, target over raw; a document is kept when no base rule fails it and ``llr`` is not under the
    threshold, the same for all.  A missing or empty text has no words and fails; a missing key stays; repeated rows
    give repeated rows; an empty table gives an empty result; other columns are ignored.  Rows are independent: the
    model is one row of fixed size, and nothing of a document is shuffled.
    """
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    read = rows.select(
        "_key", F.length("_text").alias("_length"), _parts(F.col("_text")).alias("_parts"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD)).alias("_lines"),
    )
    read = _with_repeats(_with_hashes(read)).withColumn("_ratios", ratios.scalar())
    add = lambda s, h: s + F.get("_ratios", F.pmod(h, F.lit(BUCKETS)).cast("int"))
    read = read.select(
        "_key", "n_symbols", "n_repeat_words", F.size("_words").cast("long").alias("n_words"),
        (F.col("_length") - F.size("_parts") + 1).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate("_twos", F.aggregate("_ones", F.lit(0.0), add), add).alias("_sum"), (2 * F.size("_words")).alias("_n"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    read = read.withColumn("llr", F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n"))).withColumn("base_failed", failed)
    return read.select(
        F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr",
        (~F.col("base_failed") & F.coalesce(F.col("llr") >= threshold, F.lit(False))).alias("kept"),
    )


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn both models and judge every document."""
    return judge(docs, learn(docs, trusted_documents(labels, key=key), key, text), threshold, key, text)
