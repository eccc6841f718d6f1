"""Queries: projections, filters, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions import dates as D
from carelens.functions import nulls as N
from carelens.functions import text as X
from carelens.operators import select as S
from carelens.plans.survey import centred, oriented, raw_value
from workload.registry import query, r6
from workload.views import ITEMS, table, view


@query("proj_select_pattern", "SELECT response_id, imat_d1_mean, imat_d2_mean, imat_d3_mean, imat_d4_mean, imat_d5_mean, imat_d6_mean, imat_d7_mean FROM v_imat")
def _(spark, d):
    return S.select_pattern(view(spark, d, "v_imat"), ["response_id"], prefix="imat_d", suffix="_mean", drop_suffix="_c")


@query("proj_rename_swap", "SELECT date, program_id, type AS site_type, b1 AS b2, b2 AS b1, b4 FROM v_month")
def _(spark, d):
    df = view(spark, d, "v_month").select("date", "program_id", "type", "b1", "b2", "b4")
    return S.rename_map(df, {"b1": "b2", "b2": "b1", "type": "site_type"})


@query("proj_rename_with_counts", """
SELECT date, max(CASE WHEN type = 'PC' THEN b1 END) AS "PC (n=8)", max(CASE WHEN type = 'SUD' THEN b1 END) AS "SUD (n=17)"
FROM v_month GROUP BY date""")
def _(spark, d):
    df = view(spark, d, "v_month")
    sizes = df.groupBy("type").agg(F.count_distinct("program_id").alias("n"))
    counts = {r["type"]: r["n"] for r in sizes.collect()}  # two site types
    wide = df.groupBy("date").agg(*[F.max(F.when(F.col("type") == t, F.col("b1"))).alias(t) for t in sorted(counts)])
    return S.label_with_counts(wide, counts)


@query("proj_across", """
SELECT row_id, CASE WHEN pr_moud_prescriber_1 <> '' THEN pr_moud_prescriber_1 END AS pr_moud_prescriber_1,
       CASE WHEN pr_moud_prescriber_2 <> '' THEN pr_moud_prescriber_2 END AS pr_moud_prescriber_2,
       CASE WHEN pr_id <> '' THEN pr_id END AS pr_id FROM v_registry""")
def _(spark, d):
    cols = ["pr_moud_prescriber_1", "pr_moud_prescriber_2", "pr_id"]
    return S.across(view(spark, d, "v_registry").select("row_id", *cols), cols, N.blank_to_null)


@query("proj_if_else", """
SELECT response_id, CASE WHEN cdi_outer_1 = 8 THEN 0 ELSE cdi_outer_1 - 4 END AS scaled_value,
       CASE WHEN cdi_outer_1 IN (1, 2, 3, 4, 5, 6, 7) THEN cdi_outer_1 END AS raw_value FROM v_survey""")
def _(spark, d):
    v = F.col("cdi_outer_1")
    return view(spark, d, "v_survey").select("response_id", centred(v).alias("scaled_value"), raw_value(v).alias("raw_value"))


@query("proj_case_when", """
SELECT rx_id, CASE WHEN strpos(rx_name, 'VIVITROL') > 0 THEN 34 WHEN strpos(rx_name, 'SUBLOCADE') > 0 THEN 34
       ELSE TRY_CAST(replace(regexp_extract(rx_quantity, '[0-9][0-9,]*'), ',', '') AS DOUBLE) END AS est_rx_days FROM v_rx""")
def _(spark, d):
    injected = X.contains_any(F.col("rx_name"), fixed.INJECTIONS)
    days = F.when(injected, float(fixed.INJECTION_DAYS)).otherwise(X.parse_number(F.col("rx_quantity")))
    return view(spark, d, "v_rx").select("rx_id", days.alias("est_rx_days"))


@query("proj_recode_map", """
SELECT r.response_id, m.y AS rescaled, CASE s.demo_goal WHEN 1 THEN 'Start MOUD' WHEN 2 THEN 'Expand MOUD' END AS goal
FROM v_imat r LEFT JOIN (VALUES (1, 1.0::DOUBLE), (2, 2.5), (3, 4.0), (4, 5.5), (5, 7.0)) m(x, y) ON r.imat_d5_6 = m.x
JOIN v_site s USING (program_id)""")
def _(spark, d):
    sites = S.small_side(view(spark, d, "v_site").select("program_id", "demo_goal"))
    return view(spark, d, "v_imat").join(sites, "program_id").select(
        "response_id", N.recode(F.col("imat_d5_6"), fixed.FIVE_TO_SEVEN).alias("rescaled"),
        N.recode(F.col("demo_goal"), fixed.GOAL_LABELS).alias("goal"),
    )


@query("proj_label_lookup", """
SELECT l.date, l.program_id, l.variable, round(l.value, 6) AS value, CASE l.variable
  WHEN 'reaim_c6' THEN 'Referred and linkage confirmed' WHEN 'reaim_c7' THEN 'Referred but did not confirm linkage'
  WHEN 'reaim_c8' THEN 'No referral' END AS label FROM v_long l""")
def _(spark, d):
    df = view(spark, d, "v_long").select("date", "program_id", "variable", "value")
    return r6(S.label(df, "variable", fixed.REFERRAL_NAMES, "label"))


@query("proj_null_sum", """
SELECT date, program_id, CASE WHEN b4x IS NULL AND c1_n IS NULL THEN NULL ELSE ifnull(b4x, 0) + ifnull(c1_n, 0) END AS total
FROM (SELECT *, CASE WHEN b4 > 2 THEN b4 END AS b4x FROM v_month)""")
def _(spark, d):
    df = view(spark, d, "v_month").withColumn("b4x", F.when(F.col("b4") > 2, F.col("b4")))
    return df.select("date", "program_id", N.null_sum(F.col("b4x"), F.col("c1_n")).alias("total"))


@query("proj_pct_clamped", """
SELECT date, program_id, round(CASE WHEN b2 = 0 THEN NULL WHEN b1 > b2 THEN 100 ELSE b1 / b2 * 100 END, 6) AS pct_b2,
       round(CASE WHEN b4 = 0 THEN NULL WHEN b1 > b4 THEN 100 ELSE b1 / b4 * 100 END, 6) AS pct_b4,
       round(CASE WHEN b1 = 0 THEN NULL WHEN c1_n > b1 THEN 100 ELSE c1_n / b1 * 100 END, 6) AS pct_c1 FROM v_month""")
def _(spark, d):
    b1, b2, b4, c1 = (F.col(c) for c in ("b1", "b2", "b4", "c1_n"))
    return r6(view(spark, d, "v_month").select(
        "date", "program_id", N.pct_clamped(b1, b2).alias("pct_b2"), N.pct_clamped(b1, b4).alias("pct_b4"),
        N.pct_clamped(c1, b1).alias("pct_c1"),
    ))


@query("proj_pct_zero_default", """
SELECT date, program_id, round(CASE WHEN b4 = 0 OR c1_n IS NULL THEN 0 WHEN c1_n > b4 THEN 100 ELSE c1_n / b4 * 100 END, 6) AS pct
FROM v_month""")
def _(spark, d):
    return r6(view(spark, d, "v_month").select(
        "date", "program_id", N.pct_zero_default(F.col("c1_n"), F.col("b4")).alias("pct")
    ))


@query("proj_replace_na", "SELECT date, program_id, ifnull(c1_n, 0) AS c1_n FROM v_month")
def _(spark, d):
    return view(spark, d, "v_month").select("date", "program_id", "c1_n").fillna({"c1_n": 0})


@query("filt_withdrawn", "SELECT response_id, program_id, imp_support FROM v_survey WHERE imp_support IN (1)")
def _(spark, d):
    return S.drop_withdrawn(view(spark, d, "v_survey").select("response_id", "program_id", "imp_support"))


@query("filt_complete_forms", """
SELECT program_id, count(*) AS n, (SELECT count(*) FROM v_registry WHERE form_complete <> 2) AS n_discarded
FROM v_registry WHERE form_complete = 2 GROUP BY program_id""")
def _(spark, d):
    from carelens.operators.joins import beside_totals

    df = view(spark, d, "v_registry")
    kept = S.keep_complete(df, "form_complete").groupBy("program_id").agg(F.count(F.lit(1)).alias("n"))
    return beside_totals(kept, S.count_incomplete(df, "form_complete").select("n_discarded"))


@query("filt_any_not_null", """
SELECT response_id FROM v_survey WHERE NOT (cdi_outer_1 IS NULL AND cdi_inner_12 IS NULL)""")
def _(spark, d):
    return S.filter_any_not_null(view(spark, d, "v_survey"), ["cdi_outer_1", "cdi_inner_12"]).select("response_id")


@query("filt_membership", """
SELECT date, program_id, variable, round(value, 6) AS value FROM v_long
WHERE regexp_matches(variable, '^reaim_b4') AND program_id NOT IN ('id54','id55','id56','id57','id58','id59','id60','id61','id62')
  AND strpos(program_id, '3') > 0""")
def _(spark, d):
    df = view(spark, d, "v_long").filter(
        F.col("variable").startswith("reaim_b4") & ~F.col("program_id").isin(fixed.FACTOR_EXCLUDED_SITES)
        & F.col("program_id").contains("3")
    )
    return r6(df.select("date", "program_id", "variable", "value"))


@query("filt_event_equals", "SELECT response_id, date FROM v_survey WHERE date = DATE '1998-09-01'")
def _(spark, d):
    df = view(spark, d, "v_survey").filter(F.col("event_name") == "sep_1998_arm_1")
    return df.select("response_id", D.month_from_event(F.col("event_name")).alias("date"))


@query("filt_listwise_complete", f"SELECT response_id FROM v_survey WHERE {' AND '.join(c + ' IS NOT NULL' for c in ITEMS)}")
def _(spark, d):
    return view(spark, d, "v_survey").na.drop(subset=ITEMS).select("response_id")


@query("filt_within_interval", """
SELECT ID, init_date FROM v_register WHERE init_date >= DATE '1998-06-01' AND init_date < DATE '1998-07-01'""")
def _(spark, d):
    from carelens.plans.archive import within_month

    return view(spark, d, "v_register").filter(within_month(F.col("init_date"), "1998-06-01")).select("ID", "init_date")


@query("distinct_rows", "SELECT id_from_site, encounter_date FROM v_visit GROUP BY ALL")
def _(spark, d):
    return view(spark, d, "v_visit").select("id_from_site", "encounter_date").dropDuplicates()


@query("fn_month_from_event", "SELECT response_id, date FROM v_survey")
def _(spark, d):
    return view(spark, d, "v_survey").select("response_id", D.month_from_event(F.col("event_name")).alias("date"))


@query("fn_parse_dates", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def _(spark, d):
    patterns = ["yyyy-MM-dd", "MM/dd/yyyy", "MMM d yyyy", "yyyyMMdd"]
    k = F.col("o_orderkey") % 5
    text = F.lit("unknown")
    for i, p in enumerate(patterns):
        text = F.when(k == i, F.date_format("o_orderdate", p)).otherwise(text)
    return table(spark, d, "orders").select("o_orderkey", D.parse_date(text, patterns).alias("day"))


@query("fn_month_label", """
SELECT o_orderkey, strftime(o_orderdate, '%b %Y') AS long_label, strftime(o_orderdate, '%b-%y') AS short_label FROM orders""")
def _(spark, d):
    day = F.col("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", D.month_label(day).alias("long_label"), D.month_label(day, "MMM-yy").alias("short_label")
    )


@query("fn_month_shift", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - to_months(CAST(4 - (1 + o_orderkey % 3) AS INT)) AS DATE) AS month FROM orders""")
def _(spark, d):
    code = (1 + F.col("o_orderkey") % 3).cast("int")
    return table(spark, d, "orders").select("o_orderkey", D.month_back(D.month_start("o_orderdate"), code).alias("month"))


@query("fn_month_end", "SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", D.month_end("o_orderdate").alias("month_end"))


@query("fn_date_diff", "SELECT ID, CAST(refill2_date - diag_date AS INT) AS days FROM v_register")
def _(spark, d):
    return view(spark, d, "v_register").select("ID", D.days_between("refill2_date", "diag_date").alias("days"))


@query("fn_date_add_days", """
SELECT rx_id, CASE WHEN date_diff('day', DATE '1970-01-01', rx_order_date) + floor(TRY_CAST(replace(regexp_extract(rx_quantity, '[0-9][0-9,]*'), ',', '') AS DOUBLE)) BETWEEN -719162 AND 2932896 THEN CAST(rx_order_date + CAST(floor(TRY_CAST(replace(regexp_extract(rx_quantity, '[0-9][0-9,]*'), ',', '') AS DOUBLE)) AS INT) AS DATE) END AS until FROM v_rx""")
def _(spark, d):
    until = D.add_days(F.col("rx_order_date"), X.parse_number(F.col("rx_quantity")))
    return view(spark, d, "v_rx").select("rx_id", until.alias("until"))


@query("fn_parse_number", "SELECT rx_id, TRY_CAST(replace(regexp_extract(rx_quantity, '[0-9][0-9,]*'), ',', '') AS DOUBLE) AS quantity FROM v_rx")
def _(spark, d):
    return view(spark, d, "v_rx").select("rx_id", X.parse_number(F.col("rx_quantity")).alias("quantity"))


@query("fn_regex_test", """
SELECT program_id, regexp_matches(demo_level_of_care, '[12]') AS outpatient, regexp_matches(demo_level_of_care, '[345]') AS inpatient
FROM v_site""")
def _(spark, d):
    level = F.col("demo_level_of_care")
    return view(spark, d, "v_site").select(
        "program_id", X.contains_any(level, ["1", "2"]).alias("outpatient"),
        X.contains_any(level, ["3", "4", "5"]).alias("inpatient"),
    )


@query("fn_substring", """
SELECT response_id, substr(program_id, length(program_id) - 1) AS site_code, substr(event_name, 1, 8) AS month_text FROM v_survey""")
def _(spark, d):
    return view(spark, d, "v_survey").select(
        "response_id", F.right("program_id", F.lit(2)).alias("site_code"), F.substring("event_name", 1, 8).alias("month_text")
    )


@query("fn_pad_left", """
SELECT o_orderkey, CASE WHEN o_orderkey < 1000 THEN printf('%04d', o_orderkey) ELSE CAST(o_orderkey AS VARCHAR) END AS code FROM orders""")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.pad_left(F.col("o_orderkey").cast("string"), 4).alias("code"))


@query("fn_concat", """
SELECT date, program_id, CASE WHEN c1_n IS NOT NULL THEN CAST(c1_n AS VARCHAR) || '/' || CAST(b2 AS VARCHAR) END AS label FROM v_month""")
def _(spark, d):
    text = F.concat(F.col("c1_n").cast("string"), F.lit("/"), F.col("b2").cast("string"))
    return view(spark, d, "v_month").select("date", "program_id", text.alias("label"))


@query("fn_replace", "SELECT p_partkey, regexp_replace(p_name, ' ', '_', 'g') AS name FROM part")
def _(spark, d):
    lines = F.replace(F.col("p_name"), F.lit(" "), F.lit("\n"))
    return table(spark, d, "part").select("p_partkey", F.replace(X.flatten_lines(lines), F.lit(" "), F.lit("_")).alias("name"))


@query("fn_round_half_even", "SELECT p_partkey, round_even(p_size / 8, 2) AS eighths FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", F.bround(F.col("p_size") / 8, 2).alias("eighths"))


@query("fn_blank_to_null", "SELECT row_id, nullif(pr_id, '') AS pr_id FROM v_registry")
def _(spark, d):
    return view(spark, d, "v_registry").select("row_id", N.blank_to_null(F.col("pr_id")).alias("pr_id"))


@query("fn_try_number", "SELECT row_id, TRY_CAST(pr_moud_prescriber_mo_1 AS DOUBLE) AS code, TRY_CAST(pr_id AS DOUBLE) AS pr FROM v_registry")
def _(spark, d):
    return view(spark, d, "v_registry").select(
        "row_id", N.try_number(F.col("pr_moud_prescriber_mo_1")).alias("code"), N.try_number(F.col("pr_id")).alias("pr")
    )


@query("fn_reverse_center", """
SELECT response_id, CASE WHEN cdi_inner_12 = 8 THEN 0 ELSE 4 - cdi_inner_12 END AS reversed,
       CASE WHEN cdi_inner_1 = 8 THEN 0 ELSE cdi_inner_1 - 4 END AS plain FROM v_survey""")
def _(spark, d):
    return view(spark, d, "v_survey").select(
        "response_id", oriented(centred(F.col("cdi_inner_12")), F.lit(True)).alias("reversed"),
        oriented(centred(F.col("cdi_inner_1")), F.lit(False)).alias("plain"),
    )


@query("fn_site_type_from_id", "SELECT response_id, CASE WHEN CAST(substr(program_id, 3) AS INT) < 50 THEN 'SUD' ELSE 'PC' END AS type FROM v_survey")
def _(spark, d):
    return view(spark, d, "v_survey").select("response_id", X.site_type(F.col("program_id")).alias("type"))


@query("fn_site_group", """
SELECT response_id, CASE WHEN CAST(substr(program_id, 3) AS INT) BETWEEN 53 AND 62 THEN 'PC_group1' ELSE program_id END AS site_group FROM v_survey""")
def _(spark, d):
    group = X.site_group(F.col("program_id"), fixed.COLLAPSED_SITES, "PC_group1")
    return view(spark, d, "v_survey").select("response_id", group.alias("site_group"))


