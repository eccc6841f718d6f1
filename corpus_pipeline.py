"""From documents to packed training sequences, in five stages; each is written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelens.llm import jaccard, langid, mixing, packing, secret_scan
from carelens.sources.staging import stage

MAX_REPEATS = 2.0  # passes over the smallest source


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language by more than an even chance, go."""
    langs, model = langid.train(docs.where(~langid.held_out(docs["doc_id"])))
    return langid.keep_identified(docs, langs, model)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 per cent of their five-word shingles the one with the smallest id stays."""
    return jaccard.drop_linked(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in them are masked, and their characters counted again."""
    return secret_scan.mask_secrets(docs, length="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once; documents of smaller sources again, as the weights have it."""
    _, sources = mixing.mix_plan(docs, max_repeats=MAX_REPEATS)
    return mixing.realise(docs, sources)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: its document, its place there, its sequence and its place there."""
    return packing.pack(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("jaccard_join", keep_one_of_each_group),
    ("secret_scans", mask_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None  # models and tokenizers are beyond SQL; the tests compare each stage with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
