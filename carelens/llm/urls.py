"""URL filter: expressions of each URL meet the rules by short hash prefix, then by full digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.sources.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PREFIX_HEX = 8  # characters of the digest two sides meet on: 32 bits


def _digest(host, path):
    """The length of the host keeps (host, path) pairs apart that read alike when joined."""
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit(":"), host, path), 256)


def _labels(host):
    return F.split(host, r"\.", -1)


def split_url(url):
    """Host (A-Z lower-cased) and path; both empty for a missing URL or one without ``://``."""
    part = [F.coalesce(F.regexp_extract(url, PARTS, i), F.lit("")) for i in (1, 2)]
    return F.translate(part[0], UPPER, LOWER), part[1]


def judge_urls(urls: DataFrame, rules: DataFrame, key: str, url: str, default: str = "allow") -> DataFrame:
    """Verdict of every URL: key, host, path, rule (host and path of the rule that won, else null), verdict.

    ``rules`` has host, path and verdict (allow or block).  A rule fits its host and all subdomains when the
    path of the URL starts with its path; the longest rule (host and path together) wins, then the one with the
    longer host, then block.  Without a rule the verdict is ``default``.

    URLs are reduced to distinct (host, start of path) pairs first; only those are expanded.  Host suffixes meet the
    hosts of rules by an equi-join on the first 32 bits of SHA-256, and get the path lengths those have; so a URL is
    expanded into path prefixes of the lengths of its own hosts' rules only, however many shapes the rules have.
    Expressions and rules meet in the same way; full digests confirm.  Other columns of ``urls`` are ignored.

    Missing, malformed and empty URLs have no host and get the default.  Repeated rows give repeated rows; a
    missing key stays missing.  No rules, or rules with a missing part or an empty host: they fit nothing.
    """
    pages = urls.select(F.col(key).alias("_key"), *[c.alias(n) for c, n in zip(split_url(F.col(url)), ("_host", "_path"))])
    known = rules.select(
        F.translate(F.col("host"), UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")
    ).where("r_host <> '' AND r_path IS NOT NULL AND r_verdict IS NOT NULL").distinct()
    out = [F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path")]
    most = known.agg(F.max(F.size(_labels(F.col("r_host")))).alias("labels"), F.max(F.length("r_path")).alias("path")).first()  # two numbers
    if most.labels is None:
        return pages.select(*out, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    pages = pages.withColumn("_head", F.left("_path", F.lit(most.path)))
    heads = pages.select("_host", "_head").where("_host <> ''").distinct().withColumn("_labels", _labels(F.col("_host")))
    lengths = F.sequence(F.lit(1), F.least(F.size("_labels"), F.lit(most.labels)))
    suffix = F.explode(F.transform(lengths, lambda n: F.array_join(F.slice("_labels", -n, n), ".")))
    hosts = known.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("r_lengths"))  # as many as a path is long
    hosts = hosts.withColumn("r_key", F.left(F.sha2("r_host", 256), F.lit(PREFIX_HEX)))
    expressions = (
        heads.withColumn("_suffix", suffix).withColumn("_of", F.left(F.sha2("_suffix", 256), F.lit(PREFIX_HEX)))
        .join(hosts, F.col("_of") == F.col("r_key")).where("_suffix = r_host")
        .withColumn("_m", F.explode("r_lengths")).where("length(_head) >= _m")
        .select("_host", "_head", _digest(F.col("_suffix"), F.left("_head", F.col("_m"))).alias("_full"))
        .withColumn("_short", F.left("_full", F.lit(PREFIX_HEX)))
    )
    known = known.withColumn("r_full", _digest(F.col("r_host"), F.col("r_path"))).withColumn("r_short", F.left("r_full", F.lit(PREFIX_HEX)))
    rule = F.concat("r_host", "r_path")
    won = (
        expressions.join(known, F.col("_short") == F.col("r_short"))
        .where("_full = r_full")
        .groupBy("_host", "_head")
        .agg(F.max(F.struct(F.length(rule), F.length("r_host"), (F.col("r_verdict") == "block").alias("strict"), rule.alias("rule"), "r_verdict")).alias("_won"))
    )
    # written first: its size is then known, and a very common (host, path) can be split in the join
    return pages.join(stage(won, "won"), ["_host", "_head"], "left").select(
        *out, F.col("_won.rule").alias("rule"), F.coalesce("_won.r_verdict", F.lit(default)).alias("verdict")
    )
