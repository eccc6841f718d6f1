"""Reading exports and extracts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens import fixed
from carelens.functions.dates import parse_date
from carelens.functions.nulls import tokens_to_null, try_number
from carelens.operators.select import rename_map
from carelens.sources.staging import stage


def _as_schema(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)


def read_csv(spark: SparkSession, path: str, schema, sep: str = ",", **options) -> DataFrame:
    """CSV with header and forced column types; cells that do not fit become null."""
    return spark.read.schema(_as_schema(schema)).options(header=True, sep=sep, **options).csv(path)


def read_csv_nulls(spark: SparkSession, path: str, schema, tokens: list[str] = fixed.NULL_TOKENS) -> DataFrame:
    """CSV in which several texts mean null.  The reader knows one such text, so cells are read as text."""
    wanted = _as_schema(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
    raw = spark.read.schema(text).csv(path, header=True)
    return raw.select(
        *[tokens_to_null(F.col(f.name), tokens).try_cast(f.dataType).alias(f.name) for f in wanted.fields]
    )


def read_csv_rejects(
    spark: SparkSession, path: str, schema, tokens: list[str] = fixed.NULL_TOKENS, **options
) -> tuple[DataFrame, DataFrame]:
    """CSV with forced column types, and the cells that did not fit them: (table, rejects).

    ``rejects`` has file, row (of data in the file, from 1), column and text of
    every cell that became null though it is none of the null texts.  The files
    are read once; typed rows are kept with their rejected cells, and both
    results come from there.  Rows are numbered within each block a task reads,
    blocks by where they begin in their file.
    """
    wanted = _as_schema(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
    raw = spark.read.schema(text).options(header=True, **options).csv(path)
    cells, typed = [], []
    for f in wanted.fields:
        cell = tokens_to_null(F.col(f"`{f.name}`"), tokens)
        value = cell.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        cells.append(F.when(cell.isNotNull() & value.isNull(), F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("text"))))
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at")]
    kept = stage(raw.select(*typed, F.array_compact(F.array(*cells)).alias("_cells"), *place), "typed")
    blocks = kept.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))  # a row per block
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    bad = kept.filter(F.size("_cells") > 0).join(blocks, ["_file", "_block"])
    row = F.col("_at") - F.col("_first") + F.col("_before") + 1
    rejects = bad.select(F.col("_file").alias("file"), row.alias("row"), F.explode("_cells").alias("_c")).select("file", "row", "_c.column", "_c.text")
    return kept.select(*[F.col(f"`{f.name}`") for f in wanted.fields]), rejects


def rejected_counts(rejects: DataFrame) -> DataFrame:
    """How many cells of each column did not fit."""
    return rejects.groupBy("column").agg(F.count(F.lit(1)).alias("rejected"))


def snapshot_names(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of a folder (files, or folders Spark wrote), from the listing alone."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    )
    # the listing gives whole paths; the folder may be given with or without a scheme, so its own path is what counts
    place = re.escape(re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?", "", folder).rstrip("/"))
    return listing.select(F.regexp_extract("path", rf"^(?:[a-z][a-z0-9+.-]*:(?://[^/]*)?)?/*{place.removeprefix('/')}/+([^/]+)", 1).alias("entry")).distinct()


def latest_snapshot_name(spark: SparkSession, folder: str, tokens: list[str]) -> str:
    """Newest entry (by name) whose name has all tokens."""
    names = snapshot_names(spark, folder)
    for token in tokens:
        names = names.filter(F.col("entry").contains(token))
    newest = names.agg(F.max("entry")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no entry with {tokens} in {folder}")
    return newest


def latest_snapshot(spark, folder: str, tokens: list[str], schema, **kw) -> DataFrame:
    """Read only the newest export whose name has all tokens."""
    newest = latest_snapshot_name(spark, folder, tokens)
    return read_csv_nulls(spark, f"{folder.rstrip('/')}/{newest}", schema, **kw)


def load_visits(df: DataFrame, id_header: str) -> DataFrame:
    """Visit extract: friendly names, dates, exact duplicates dropped."""
    named = rename_map(df, {id_header: "id_from_site", **fixed.VISIT_HEADERS})
    return named.withColumn("encounter_date", _extract_date("encounter_date")).dropDuplicates()


def load_prescriptions(df: DataFrame, id_header: str) -> DataFrame:
    """Prescription extract: friendly names, dates, exact duplicates dropped."""
    named = rename_map(df, {id_header: "id_from_site", **fixed.PRESCRIPTION_HEADERS})
    return named.withColumn("rx_order_date", _extract_date("rx_order_date")).dropDuplicates()


def _extract_date(col: str):
    return parse_date(F.col(col).cast("string"), ["yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "yyyy-MM-dd HH:mm:ss"])


def load_manual(df: DataFrame, value: str = "final.value", formats=fixed.MANUAL_DATE_FORMATS) -> DataFrame:
    """Manual measures: month in several spellings, text to number, fixed columns."""
    return df.select(
        parse_date(F.col("date"), formats).alias("date"),
        "program_id",
        "variable",
        try_number(F.col(f"`{value}`")).alias("value"),
    )
