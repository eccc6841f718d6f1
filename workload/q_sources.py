"""Queries: sources and sinks, as round trips of whole tables through the shared folder."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from carelens import fixed
from carelens.sources import readers as R
from carelens.sources import published, staging
from carelens.sources import writers as W
from workload.registry import query, r6
from workload.views import BASE_MONTHS, BASE_VARS, table, view

SURVEY_SCHEMA = "response_id bigint, program_id string, cdi_outer_1 int"


@query("src_latest_snapshot", "SELECT response_id, program_id, cdi_outer_1 FROM v_survey WHERE type = 'SUD'")
def _(spark, d):
    folder = staging.new_folder(spark)
    df = view(spark, d, "v_survey").select("response_id", "program_id", "cdi_outer_1", "type")
    for day, kind in (("20230101", "SUD"), ("20230401", "PC"), ("20230401", "SUD")):
        answers = df.filter(F.col("type") == kind).drop("type")
        if day == "20230101":
            answers = answers.withColumn("cdi_outer_1", F.lit(0))
        W.write_csv(answers, f"{folder}/CDI_{day}_{kind}.csv")
    return R.latest_snapshot(spark, folder, ["CDI", "SUD"], SURVEY_SCHEMA)


_BASE_COLS = [f"demo_moud_{v}_{m}" for v in BASE_VARS for m in BASE_MONTHS]


@query("src_csv_null_tokens", f"""
SELECT program_id, {", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in _BASE_COLS)} FROM v_baseline""")
def _(spark, d):
    path = W.write_csv(view(spark, d, "v_baseline").select("program_id", *_BASE_COLS), f"{staging.new_folder(spark)}/base.csv")
    return R.read_csv_nulls(spark, path, "program_id string, " + ", ".join(f"{c} double" for c in _BASE_COLS))


@query("src_csv_typed", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def _(spark, d):
    df = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate")
    )
    path = W.write_csv(df, f"{staging.new_folder(spark)}/orders.csv")
    return R.read_csv(
        spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date"
    )


@query("src_csv_rejects", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS rejected FROM orders""")
def _(spark, d):
    price = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.col("o_totalprice").cast("string"))
    path = W.write_csv(table(spark, d, "orders").select("o_orderkey", price.alias("price")), f"{staging.new_folder(spark)}/orders.csv")
    good, bad = R.read_csv_rejects(spark, path, "o_orderkey bigint, price double")
    counts = R.rejected_counts(bad).filter(F.col("column") == "price").select("rejected")
    return good.withColumn("rejected", F.coalesce(counts.scalar(), F.lit(0).cast("bigint")))


@query("src_extract_renamed", "SELECT DISTINCT id_from_site, rx_order_date, rx_name, rx_quantity, rx_num_refills, rx_provider, rx_site_name FROM v_rx")
def _(spark, d):
    rx = view(spark, d, "v_rx").drop("rx_id").withColumn("rx_order_date", F.col("rx_order_date").cast("string"))
    kept = list(rx.columns)
    raw_names = {v: k for k, v in fixed.PRESCRIPTION_HEADERS.items()} | {"id_from_site": "patient number"}
    missing = [c for c in fixed.PRESCRIPTION_HEADERS.values() if c not in kept]
    raw = rx.select(*[F.col(c).alias(raw_names[c]) for c in kept], *[F.lit("").alias(raw_names[c]) for c in missing])
    return R.load_prescriptions(raw.union(raw), "patient number").select(*kept)


@query("src_manual_records", """
SELECT date, program_id, variable, CASE WHEN month(date) = 7 THEN NULL ELSE value END AS value FROM v_long""")
def _(spark, d):
    long = view(spark, d, "v_long")
    m = F.month("date") % 4
    text = F.date_format("date", "MMM-yy")
    for n, pattern in enumerate(["MMM-yyyy", "MMM yy", "MMM yyyy"], 1):
        text = F.when(m == n, F.date_format("date", pattern)).otherwise(text)
    value = F.when(F.month("date") == 7, "not reported").otherwise(F.col("value").cast("string"))
    return R.load_manual(long.select(text.alias("date"), "program_id", "variable", value.alias("final.value")))


@query("sink_stage_table", "SELECT date, program_id, variable, round(value, 6) AS value FROM v_long")
def _(spark, d):
    long = view(spark, d, "v_long").select("date", "program_id", "variable", "value")
    return r6(staging.read_stage(spark, staging.save_stage(long, "long_measures")))


@query("sink_published_table", "SELECT date, program_id, variable, round(value, 6) AS value FROM v_long")
def _(spark, d):
    long, root = view(spark, d, "v_long").select("date", "program_id", "variable", "value"), staging.new_folder(spark)
    published.publish(long.withColumn("value", F.lit(0.0)).limit(10), root, "long_measures")
    published.publish(long, root, "long_measures")
    return r6(published.read_published(spark, root, "long_measures"))


@query("sink_csv_dated", """
SELECT date, program_id, b1, c1_n, 'measures_20230401.csv' AS name FROM v_month""")
def _(spark, d):
    months = view(spark, d, "v_month").select("date", "program_id", "b1", "c1_n")
    path = W.write_csv(
        months, f"{staging.new_folder(spark)}/measures.csv", dated=True, today=datetime.date(2023, 4, 1)
    )
    back = R.read_csv_nulls(spark, path, "date date, program_id string, b1 bigint, c1_n bigint")
    return back.withColumn("name", F.lit(path.rsplit("/", 1)[-1]))


@query("sink_tsv", "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def _(spark, d):
    path = W.write_csv(
        table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"),
        f"{staging.new_folder(spark)}/orders.tsv", sep="\t",
    )
    return R.read_csv(spark, path, "o_orderkey bigint, o_orderpriority string, o_orderstatus string", sep="\t")


@query("sink_wide_export", """
SELECT strftime(date, '%Y-%m-%d') || ',' || program_id || ',' || ifnull(CAST(c1_n AS VARCHAR), '') AS value FROM v_month""")
def _(spark, d):
    path = W.write_csv(
        view(spark, d, "v_month").select("date", "program_id", "c1_n"), f"{staging.new_folder(spark)}/wide.csv", null=""
    )
    return spark.read.text(path).filter(F.col("value") != "date,program_id,c1_n")
