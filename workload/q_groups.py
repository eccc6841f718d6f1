"""Queries: aggregates and ordered operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions import nulls as N
from carelens.operators import aggs as A
from carelens.operators import windows as W
from carelens.operators.ordered import find_hot
from carelens.operators.select import left_lookup, small_side
from carelens.plans import patients as P
from carelens.plans.survey import score_answers
from workload.registry import query, r6
from workload.views import IMAT_ITEMS, ITEMS, table, view

# scored answers, written without the library: joins instead of CASE chains
_DICT = ", ".join(f"('{i}', '{q}', '{s}', {str(r).lower()}, '{i.split('_')[1]}')" for q, i, s, r in fixed.SURVEY_ITEMS)
_LONG = " UNION ALL ".join(
    f"SELECT response_id, program_id, type, date, imp_support, '{c}' AS item, {c} AS value FROM v_survey WHERE {c} IS NOT NULL"
    for c in ITEMS
)
SCORED = f"""answers AS ({_LONG}),
scored AS (SELECT a.*, d.q_num, d.subscale, d.level, nullif(value, 8) AS raw_value,
    (CASE WHEN value = 8 THEN 0 ELSE value - 4 END) * (CASE WHEN d.rev THEN -1 ELSE 1 END) AS scaled_value,
    CASE WHEN value <> 8 THEN 4 + (value - 4) * (CASE WHEN d.rev THEN -1 ELSE 1 END) END AS oriented_value,
    ['barriers', 'neutral', 'facilitators'][2 + CAST(sign((CASE WHEN value = 8 THEN 0 ELSE value - 4 END)
       * (CASE WHEN d.rev THEN -1 ELSE 1 END)) AS INT)] AS cat
  FROM answers a JOIN (VALUES {_DICT}) d(item, q_num, subscale, rev, level) USING (item))"""
IDS = ["response_id", "program_id", "type", "date", "imp_support"]


def scored(spark, d):
    return score_answers(view(spark, d, "v_survey"), IDS)


def flags(spark, d):
    """Prescription flags with plain keys, for the window queries."""
    rx = view(spark, d, "v_rx")
    hot = find_hot(rx, ["id_from_site"], P.RX_ORDER)
    days = F.when(F.col("rx_name").contains("BUPRENORPHINE"), P.parse_number(F.col("rx_quantity"))).otherwise(34.0)
    return W.flag_restarts(
        rx.withColumn("est_rx_days", days), ["id_from_site"], P.RX_ORDER, "rx_order_date", "est_rx_days",
        "rx_num_refills", hot=hot,
    ), hot


@query("agg_five_stats", f"""
WITH {SCORED} SELECT q_num, type, round(avg(raw_value), 6) AS mean, round(stddev_samp(raw_value), 6) AS sd,
  median(raw_value)::DOUBLE AS median, min(raw_value)::DOUBLE AS min, max(raw_value)::DOUBLE AS max FROM scored GROUP BY q_num, type""")
def _(spark, d):
    return r6(A.describe_by(scored(spark, d), ["q_num", "type"], "raw_value"))


@query("agg_mean_by", f"WITH {SCORED} SELECT program_id, subscale, round(avg(raw_value), 6) AS mean FROM scored GROUP BY ALL")
def _(spark, d):
    return r6(A.mean_by(scored(spark, d), ["program_id", "subscale"], "raw_value"))


@query("agg_null_propagating", """
SELECT program_id, CASE WHEN bool_or(c1_n IS NULL) THEN NULL ELSE round(avg(c1_n), 6) END AS mean_v,
  CASE WHEN bool_or(c1_n IS NULL) THEN NULL ELSE max(c1_n) END AS max_v, round(avg(b1), 6) AS b1_mean FROM v_month GROUP BY program_id""")
def _(spark, d):
    return r6(view(spark, d, "v_month").groupBy("program_id").agg(
        N.strict(F.avg, F.col("c1_n")).alias("mean_v"), N.strict(F.max, F.col("c1_n")).alias("max_v"),
        N.strict(F.avg, F.col("b1")).alias("b1_mean"),
    ))


@query("agg_quantiles", """
SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.25), 6) AS ptile25, round(quantile_cont(l_extendedprice, 0.75), 6) AS ptile75
FROM lineitem GROUP BY ALL""")
def _(spark, d):
    return r6(A.quantiles_by(
        table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", {"ptile25": 0.25, "ptile75": 0.75}
    ))


@query("agg_count_rows", "SELECT program_id, date, count(*) AS n FROM v_survey GROUP BY ALL")
def _(spark, d):
    return view(spark, d, "v_survey").groupBy("program_id", "date").agg(F.count(F.lit(1)).alias("n"))


@query("agg_count_distinct", """
SELECT rx_site_name, date_trunc('month', rx_order_date)::DATE AS month, count(DISTINCT ifnull(rx_provider, '?')) AS value FROM v_rx GROUP BY ALL""")
def _(spark, d):
    return view(spark, d, "v_rx").groupBy("rx_site_name", F.trunc("rx_order_date", "MM").alias("month")).agg(
        N.n_unique(F.col("rx_provider")).alias("value")
    )


@query("agg_entity_counts", """
SELECT count(DISTINCT program_id) FILTER (type = 'SUD') AS "SUD_n", count(DISTINCT program_id) FILTER (type = 'PC') AS "PC_n",
  count(DISTINCT program_id) AS all_n FROM v_survey""")
def _(spark, d):
    return A.entity_counts(view(spark, d, "v_survey"), "program_id", "type", fixed.SITE_TYPES)


@query("agg_subtotal_rows", """
SELECT program_id, type, CASE WHEN grouping(date) = 1 THEN 'total' ELSE strftime(date, '%Y-%m-%d') END AS month, CAST(sum(b1) AS BIGINT) AS b1,
  CAST(sum(b4) AS BIGINT) AS b4 FROM v_month GROUP BY GROUPING SETS ((program_id, type, date), (program_id, type))""")
def _(spark, d):
    months = view(spark, d, "v_month").withColumn("month", F.col("date").cast("string"))
    return A.with_total_rows(months, ["program_id", "type"], "month", ["b1", "b4"], "total")


@query("agg_type_and_all", f"""
WITH {SCORED} SELECT subscale, q_num, round(avg(oriented_value) FILTER (type = 'SUD'), 6) AS "SUD_mean_v",
  round(avg(oriented_value) FILTER (type = 'PC'), 6) AS "PC_mean_v", round(avg(oriented_value), 6) AS all_mean_v FROM scored GROUP BY ALL""")
def _(spark, d):
    return r6(A.means_by_type_and_all(scored(spark, d), ["subscale", "q_num"], "oriented_value", fixed.SITE_TYPES))


@query("agg_across_means", f"""
SELECT program_id, {", ".join(f"round(avg({c}), 6) AS {c}" for c in IMAT_ITEMS)} FROM v_imat GROUP BY program_id""")
def _(spark, d):
    return r6(A.mean_all(view(spark, d, "v_imat"), ["program_id"], IMAT_ITEMS))


@query("agg_first_last", """
SELECT DISTINCT id_from_site, first_value(rx_id) OVER w AS first_rx, last_value(rx_id) OVER w AS last_rx FROM v_rx
WINDOW w AS (PARTITION BY id_from_site ORDER BY rx_order_date, rx_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def _(spark, d):
    at = F.struct(*P.RX_ORDER)
    return view(spark, d, "v_rx").groupBy("id_from_site").agg(
        F.min_by("rx_id", at).alias("first_rx"), F.max_by("rx_id", at).alias("last_rx")
    )


@query("agg_row_mean", f"""
SELECT response_id, round(list_avg([{", ".join(fixed.LOW_BARRIER_ITEMS)}]), 6) AS imat_s1_mean FROM v_imat""")
def _(spark, d):
    return r6(view(spark, d, "v_imat").select("response_id", N.row_mean(fixed.LOW_BARRIER_ITEMS).alias("imat_s1_mean")))


@query("agg_group_any", """
SELECT date, program_id, variable, program_id IN (SELECT program_id FROM v_long WHERE variable = 'reaim_b5p') AS new_measures FROM v_long""")
def _(spark, d):
    long = view(spark, d, "v_long").select("date", "program_id", "variable")
    return A.group_any(long, ["program_id"], F.col("variable") == "reaim_b5p", "new_measures")


_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", min({c})::DOUBLE AS min, quantile_cont({c}, 0.25)::DOUBLE AS q1, median({c})::DOUBLE AS median,
    round(avg({c}), 6) AS mean, quantile_cont({c}, 0.75)::DOUBLE AS q3, max({c})::DOUBLE AS max, count(*) - count({c}) AS n_null FROM v_survey"""
    for c in ITEMS
)


@query("agg_column_profile", _PROFILE)
def _(spark, d):
    return r6(A.profile(view(spark, d, "v_survey"), ITEMS))


@query("agg_rates_with_base", """
SELECT program_id, date, unnest(['reaim_c1_n', 'reaim_c1p']) AS variable,
  unnest([n::DOUBLE, round(n / b1 * 100, 6)]) AS value
FROM (SELECT program_id, date, c1_n AS n, b1 FROM v_month WHERE c1_n IS NOT NULL)""")
def _(spark, d):
    months = view(spark, d, "v_month")
    counts = months.filter("c1_n is not null").select("program_id", "date", "c1_n")
    return r6(A.count_and_pct(counts, months, ["program_id", "date"], "c1_n", "b1", ("reaim_c1_n", "reaim_c1p")))


@query("win_first_per_key", """
SELECT id_from_site, visit_id, encounter_date FROM v_visit QUALIFY row_number() OVER (PARTITION BY id_from_site ORDER BY encounter_date, visit_id) = 1""")
def _(spark, d):
    visits = view(spark, d, "v_visit").select("id_from_site", "visit_id", "encounter_date")
    return W.first_per_key(visits, "id_from_site", P.VISIT_ORDER)


IDS_SQL = """first_visit AS (SELECT id_from_site, encounter_date, program_id FROM v_visit LEFT JOIN v_site USING (site_name)
  QUALIFY row_number() OVER (PARTITION BY id_from_site ORDER BY encounter_date, visit_id) = 1),
ids AS (SELECT id_from_site, program_id, encounter_date, right(program_id, 2) || '-' ||
  CASE WHEN n < 10000 THEN printf('%04d', n) ELSE CAST(n AS VARCHAR) END AS pr_id
  FROM (SELECT *, row_number() OVER (PARTITION BY program_id ORDER BY encounter_date, id_from_site) AS n FROM first_visit))"""


@query("win_surrogate_id", f"WITH {IDS_SQL} SELECT id_from_site, program_id, encounter_date, pr_id FROM ids")
def _(spark, d):
    visits = view(spark, d, "v_visit")
    sites = small_side(view(spark, d, "v_site").select("site_name", "program_id"))
    sited = left_lookup(visits, sites, [("site_name", "site_name")])
    hot = find_hot(sited, ["program_id"], ["encounter_date", "id_from_site"])
    first = W.first_per_key(
        sited.select("id_from_site", "encounter_date", "visit_id", "program_id"), "id_from_site", P.VISIT_ORDER
    )
    return W.assign_ids(first, "id_from_site", "program_id", "encounter_date", "pr_id", hot).drop("visit_id")


FLAGS_SQL = """lagged AS (SELECT *, CASE WHEN strpos(rx_name, 'BUPRENORPHINE') > 0 THEN TRY_CAST(replace(regexp_extract(rx_quantity, '[0-9][0-9,]*'), ',', '') AS DOUBLE)
    ELSE 34 END AS est_rx_days, row_number() OVER (PARTITION BY id_from_site ORDER BY rx_order_date, rx_id) AS rn FROM v_rx),
restarts AS (SELECT b.*, NOT (b.rn = 1 OR b.rx_order_date - a.rx_order_date < 34
    OR ifnull(b.rx_order_date - a.rx_order_date < a.est_rx_days * (a.rx_num_refills + 1), false)) AS is_restart
  FROM lagged b LEFT JOIN lagged a ON a.id_from_site IS NOT DISTINCT FROM b.id_from_site AND a.rn = b.rn - 1),
flagged AS (SELECT a.*, ifnull(b.is_restart, true) AS is_break FROM restarts a LEFT JOIN restarts b
  ON a.id_from_site IS NOT DISTINCT FROM b.id_from_site AND b.rn = a.rn + 1)"""


@query("win_gap_restart", f"WITH {FLAGS_SQL} SELECT rx_id, is_restart FROM restarts")
def _(spark, d):
    return flags(spark, d)[0].select("rx_id", "is_restart")


@query("win_lead_break", f"WITH {FLAGS_SQL} SELECT rx_id, is_restart, is_break FROM flagged")
def _(spark, d):
    marked, hot = flags(spark, d)
    return W.flag_breaks(marked, ["id_from_site"], P.RX_ORDER, hot=hot).select("rx_id", "is_restart", "is_break")


@query("win_episode_islands", f"""
WITH {FLAGS_SQL}, opened AS (SELECT id_from_site, rn, rx_order_date AS start_date, row_number() OVER (PARTITION BY id_from_site ORDER BY rn) AS episode
    FROM flagged WHERE rn = 1 OR is_restart),
closed AS (SELECT id_from_site, CASE WHEN date_diff('day', DATE '1970-01-01', rx_order_date) + floor(est_rx_days) BETWEEN -719162 AND 2932896 THEN CAST(rx_order_date + CAST(floor(est_rx_days) AS INT) AS DATE) END AS end_date,
    row_number() OVER (PARTITION BY id_from_site ORDER BY rn) AS episode FROM flagged WHERE is_break)
SELECT o.id_from_site, CAST(o.episode AS INT) AS episode, start_date, end_date FROM opened o JOIN closed c ON o.id_from_site IS NOT DISTINCT FROM c.id_from_site AND o.episode = c.episode""")
def _(spark, d):
    marked, hot = flags(spark, d)
    return W.episodes(marked, ["id_from_site"], P.RX_ORDER, "rx_order_date", "est_rx_days", hot)


@query("win_locf", """
SELECT response_id, program_id, last_value(imp_support IGNORE NULLS) OVER (PARTITION BY program_id ORDER BY date, response_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS imp_support FROM v_survey""")
def _(spark, d):
    df = view(spark, d, "v_survey").select("response_id", "program_id", "date", "imp_support")
    hot = find_hot(df, ["program_id"], ["date", "response_id"])
    return W.locf(df, ["program_id"], ["date", "response_id"], "imp_support", hot=hot).drop("date")


@query("win_share_of_group", """
SELECT program_id, priority, n, round(n / (SELECT count(*) FROM v_survey t WHERE t.program_id = c.program_id), 6) AS share
FROM (SELECT s.program_id, o.o_orderpriority AS priority, count(*) AS n FROM orders o JOIN v_survey s ON s.response_id = o.o_orderkey
      GROUP BY 1, 2) c""")
def _(spark, d):
    joined = view(spark, d, "v_survey").join(table(spark, d, "orders"), F.col("response_id") == F.col("o_orderkey"))
    counts = joined.groupBy("program_id", F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    return r6(A.share(counts, ["program_id"], "n"))


@query("win_latest_per_key", """
SELECT l.program_id, l.variable, l.date, round(l.value, 6) AS value FROM v_long l WHERE date =
  (SELECT max(date) FROM v_long m WHERE m.program_id = l.program_id AND m.variable = l.variable)""")
def _(spark, d):
    return r6(A.latest_per_key(
        view(spark, d, "v_long").select("program_id", "variable", "date", "value"), ["program_id", "variable"], "date"
    ))


@query("win_latest_global", "SELECT program_id, date, b1 FROM v_month WHERE date IN (SELECT max(date) FROM v_month)")
def _(spark, d):
    return A.latest(view(spark, d, "v_month"), "date").select("program_id", "date", "b1")


REGISTER_SQL = " UNION ALL ".join(
    f"SELECT ID, admit_date, diag_date, disc_date, MOUD_type, {n} AS refill, {p}_prescriber AS prescriber, {p}_location AS location, "
    f"{p}_date AS date, {p}_duration AS duration FROM v_register" for n, p in enumerate(["init", *[f"refill{n}" for n in range(1, 7)]])
)


@query("win_days_off", f"""
WITH r AS ({REGISTER_SQL}) SELECT b.ID, b.refill, b.date, CAST(b.date - (a.date + CAST(a.duration AS INT)) AS INT) AS days_off_rx,
  b.date - (a.date + CAST(a.duration AS INT)) > 28 AS is_restart FROM r b LEFT JOIN r a ON a.ID = b.ID AND a.refill = b.refill - 1""")
def _(spark, d):
    from carelens.plans.archive import registry_long

    return registry_long(view(spark, d, "v_register")).select("ID", "refill", "date", "days_off_rx", "is_restart")


@query("win_zscore", """
SELECT program_id, date, round((b1 - (SELECT avg(b1) FROM v_month)) / (SELECT stddev_samp(b1) FROM v_month), 6) + 0.0 AS b1,
  round((c1_n - (SELECT avg(c1_n) FROM v_month)) / (SELECT stddev_samp(c1_n) FROM v_month), 6) + 0.0 AS c1_n FROM v_month""")
def _(spark, d):
    return r6(W.zscore(view(spark, d, "v_month").select("program_id", "date", "b1", "c1_n"), ["b1", "c1_n"]))


@query("win_visit_start_flags", """
SELECT visit_id, NOT EXISTS (SELECT 1 FROM v_visit w WHERE w.id_from_site IS NOT DISTINCT FROM v.id_from_site
  AND (w.encounter_date, w.visit_id) < (v.encounter_date, v.visit_id)) AS is_start FROM v_visit v""")
def _(spark, d):
    visits = view(spark, d, "v_visit")
    hot = find_hot(visits, ["id_from_site"], P.VISIT_ORDER)
    return W.flag_first(visits, ["id_from_site"], P.VISIT_ORDER, hot=hot).select("visit_id", "is_start")


