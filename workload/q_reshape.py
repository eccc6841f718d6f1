"""Queries: long and wide forms, joins, set operations, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.text import list_position, nth_part
from carelens.operators import joins as J
from carelens.operators import reshape as R
from carelens.operators import select as S
from carelens.operators.ordered import find_hot
from carelens.sources.staging import cut_lineage
from workload.registry import query, r6
from workload.views import BASE_MONTHS, BASE_VARS, IMAT_MEANS, ITEMS, table, view



def _stacked(source: str, cols: list[str], extra: str = "response_id", where: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {extra}, '{c}' AS item, {c} AS value FROM {source} {where.format(c=c)}" for c in cols)


@query("melt_drop_null", _stacked("v_survey", ITEMS, where="WHERE {c} IS NOT NULL"))
def _(spark, d):
    return R.melt(view(spark, d, "v_survey"), ["response_id"], ITEMS, "item", "value", drop_null=True)


@query("melt_keep_null", _stacked("v_survey", ITEMS))
def _(spark, d):
    return R.melt(view(spark, d, "v_survey"), ["response_id"], ITEMS, "item", "value")


@query("melt_split_name", " UNION ALL ".join(
    f"SELECT program_id, '{v}' AS variable, '{m}' AS month, TRY_CAST(demo_moud_{v}_{m} AS DOUBLE) AS value FROM v_baseline "
    f"WHERE TRY_CAST(demo_moud_{v}_{m} AS DOUBLE) IS NOT NULL" for v in BASE_VARS for m in BASE_MONTHS))
def _(spark, d):
    cols = [f"demo_moud_{v}_{m}" for v in BASE_VARS for m in BASE_MONTHS]
    return R.melt_split(view(spark, d, "v_baseline"), ["program_id"], cols, "demo_moud_", "_", ["variable", "month"])


@query("melt_name_pattern", " UNION ALL ".join(
    f"SELECT response_id, '{c.removesuffix('_mean')}' AS variable, round({c}, 6) AS value FROM v_imat" for c in IMAT_MEANS))
def _(spark, d):
    return r6(R.melt_regex(view(spark, d, "v_imat"), ["response_id"], r"(.*)_mean"))


@query("melt_multi_value", """
SELECT l_orderkey, l_linenumber, 1 AS block, l_quantity AS amount, l_tax AS rate FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 2, l_extendedprice, l_discount FROM lineitem""")
def _(spark, d):
    blocks = {1: {"amount": "l_quantity", "rate": "l_tax"}, 2: {"amount": "l_extendedprice", "rate": "l_discount"}}
    return R.melt_blocks(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], blocks, "block")


@query("pivot_wide", """
PIVOT (SELECT program_id, date, variable, round(value, 6) AS value FROM v_long)
ON variable IN ('reaim_b1', 'reaim_b4', 'reaim_b4p', 'reaim_b5p') USING max(value) GROUP BY program_id, date""")
def _(spark, d):
    keys = ["reaim_b1", "reaim_b4", "reaim_b4p", "reaim_b5p"]
    return r6(R.pivot(view(spark, d, "v_long"), ["program_id", "date"], "variable", "value", keys))


@query("pivot_multi_glue", """
SELECT date, round(avg(b1) FILTER (type = 'PC'), 6) AS "PC_mean", max(b1) FILTER (type = 'PC') AS "PC_top",
       round(avg(b1) FILTER (type = 'SUD'), 6) AS "SUD_mean", max(b1) FILTER (type = 'SUD') AS "SUD_top"
FROM v_month GROUP BY date""")
def _(spark, d):
    stats = view(spark, d, "v_month").groupBy("date", "type").agg(F.avg("b1").alias("mean"), F.max("b1").alias("top"))
    return r6(R.pivot_glue(stats, ["date"], "type", ["mean", "top"], ["PC", "SUD"]))


@query("pivot_fill", """
SELECT program_id, date,
  CASE WHEN count(*) FILTER (variable = 'reaim_b5') = 0 THEN 0 ELSE max(value) FILTER (variable = 'reaim_b5') END AS reaim_b5,
  CASE WHEN count(*) FILTER (variable = 'reaim_c1_n') = 0 THEN 0 ELSE max(value) FILTER (variable = 'reaim_c1_n') END AS reaim_c1_n
FROM v_long GROUP BY program_id, date""")
def _(spark, d):
    return R.pivot(view(spark, d, "v_long"), ["program_id", "date"], "variable", "value", ["reaim_b5", "reaim_c1_n"], fill=0.0)


@query("densify_zero", """
WITH n AS (SELECT p_brand || '/' || s_suppkey AS pair, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS value
           FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT i.pair, m.month, ifnull(n.value, 0) AS value FROM (SELECT DISTINCT pair FROM n) i, (SELECT DISTINCT month FROM n) m
LEFT JOIN n ON n.pair = i.pair AND n.month = m.month""")
def _(spark, d):
    lines = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    # all rows, counted by (part, supplier, month) before the brand comes in
    parts = S.small_side(table(spark, d, "part").select("p_partkey", "p_brand"))
    counts = (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy(
            F.concat_ws("/", "p_brand", "l_suppkey").alias("pair"), F.trunc("l_shipdate", "MM").alias("month")
        )
        .agg(F.count(F.lit(1)).alias("value"))
    )
    return R.densify(cut_lineage(counts), ["pair"], "month", "value")


@query("explode_delimited", """
SELECT program_id, CAST(unnest(string_split(demo_level_of_care, ',')) AS INT) AS demo_level_of_care FROM v_site""")
def _(spark, d):
    return R.explode_list(view(spark, d, "v_site").select("program_id", "demo_level_of_care"), "demo_level_of_care", ",", "int")


@query("split_key", """
SELECT response_id, split_part(event_name, '_', 1) AS mon, split_part(event_name, '_', 2) AS year FROM v_survey""")
def _(spark, d):
    return view(spark, d, "v_survey").select(
        "response_id", nth_part(F.col("event_name"), 1).alias("mon"), nth_part(F.col("event_name"), 2).alias("year")
    )


@query("compose_key", """
SELECT strftime(date, '%Y-%m-%d') || '.' || program_id || '.' || type AS key, b1 FROM v_month""")
def _(spark, d):
    return view(spark, d, "v_month").select(F.concat_ws(".", "date", "program_id", "type").alias("key"), "b1")


@query("unite_onehot", """
SELECT p_partkey, rtrim(CASE WHEN p_size % 2 = 1 THEN '1_' ELSE '' END || CASE WHEN p_size // 2 % 2 = 1 THEN '2_' ELSE '' END
  || CASE WHEN p_size // 4 % 2 = 1 THEN '3_' ELSE '' END || CASE WHEN p_size // 8 % 2 = 1 THEN '4_' ELSE '' END, '_') AS x FROM part""")
def _(spark, d):
    boxes = {f"x___{k + 1}": F.col("p_size").bitwiseAND(2**k) / 2**k for k in range(4)}
    return R.unite_onehot(table(spark, d, "part").select("p_partkey", *[c.alias(n) for n, c in boxes.items()]), "x___", "x")


@query("crosstab_counts", """
SELECT c_nationkey, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
  count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""")
def _(spark, d):
    df = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return R.crosstab(df, ["c_nationkey"], "o_orderstatus", ["F", "O", "P"])


@query("grid_expand", """
SELECT program_id, outcome, exposure FROM (SELECT DISTINCT program_id FROM v_month),
  (VALUES ('count_MOUD'), ('pct_MOUD')) a(outcome), (VALUES ('mean_likert'), ('barriers'), ('facilitators')) b(exposure)""")
def _(spark, d):
    sites = view(spark, d, "v_month").select("program_id").distinct()
    return R.name_grid(sites, {
        "outcome": ["count_MOUD", "pct_MOUD"], "exposure": ["mean_likert", "barriers", "facilitators"],
    })


_SCORING = ", ".join(f"('{i}', '{q}', '{s}')" for q, i, s, _ in fixed.SURVEY_ITEMS)


@query("join_left_dim", f"""
SELECT a.response_id, a.item, d.q_num, d.subscale FROM ({_stacked("v_survey", ITEMS, where="WHERE {c} IS NOT NULL")}) a
LEFT JOIN (VALUES {_SCORING}) d(item, q_num, subscale) ON a.item = d.item""")
def _(spark, d):
    long = R.melt(view(spark, d, "v_survey"), ["response_id"], ITEMS, "item", "value", drop_null=True).drop("value")
    dictionary = fixed.scoring_dictionary(spark).drop("isReverse").withColumnRenamed("item", "_code")
    return S.left_lookup(long, F.broadcast(dictionary), [("item", "_code")])


@query("join_left_fact", """
SELECT v.visit_id, f.first_rx FROM v_visit v
LEFT JOIN (SELECT id_from_site, min(rx_order_date) AS first_rx FROM v_rx GROUP BY 1) f ON v.id_from_site IS NOT DISTINCT FROM f.id_from_site""")
def _(spark, d):
    first = view(spark, d, "v_rx").groupBy("id_from_site").agg(F.min("rx_order_date").alias("first_rx"))
    return S.same_keys(view(spark, d, "v_visit"), first, ["id_from_site"]).select("visit_id", "first_rx")


@query("join_diff_keys", """
SELECT v.visit_id, r.n FROM v_visit v LEFT JOIN (SELECT id_from_site, rx_order_date, count(*) AS n FROM v_rx GROUP BY ALL) r
ON v.id_from_site IS NOT DISTINCT FROM r.id_from_site AND v.encounter_date = r.rx_order_date""")
def _(spark, d):
    rx = view(spark, d, "v_rx").groupBy("id_from_site", "rx_order_date").agg(F.count(F.lit(1)).alias("n"))
    pairs = [("id_from_site", "id_from_site"), ("encounter_date", "rx_order_date")]
    return S.left_lookup(view(spark, d, "v_visit"), rx, pairs).select("visit_id", "n")


@query("join_natural_left", """
SELECT m.program_id, m.type, m.date, m.b1, t.top FROM v_month m LEFT JOIN
  (SELECT program_id, type, max(b1) AS top FROM v_month WHERE type = 'PC' GROUP BY ALL) t USING (program_id, type)""")
def _(spark, d):
    months = view(spark, d, "v_month").select("program_id", "type", "date", "b1")
    return J.natural_left(months, months.filter("type = 'PC'").groupBy("program_id", "type").agg(F.max("b1").alias("top")))


@query("join_full_outer", """
SELECT coalesce(s.program_id, q.program_id) AS program_id, s.site_name, q.n FROM
  (SELECT program_id, site_name FROM v_site WHERE imp_support = 1) s FULL JOIN
  (SELECT program_id, count(*) AS n FROM v_survey WHERE type = 'PC' GROUP BY 1) q ON s.program_id = q.program_id""")
def _(spark, d):
    sites = S.drop_withdrawn(view(spark, d, "v_site")).select("program_id", "site_name")
    answers = view(spark, d, "v_survey").filter("type = 'PC'").groupBy("program_id").agg(F.count(F.lit(1)).alias("n"))
    return sites.join(answers, "program_id", "full")


@query("join_total_row", """
SELECT date, program_id, b1, CAST((SELECT sum(b1) FROM v_month) AS BIGINT) AS all_b1, (SELECT max(b1) FROM v_month) AS top_b1 FROM v_month""")
def _(spark, d):
    months = view(spark, d, "v_month").select("date", "program_id", "b1")
    return J.beside_totals(months, months.agg(F.sum("b1").alias("all_b1"), F.max("b1").alias("top_b1")))


@query("join_interval_overlap", """
SELECT r.ID, r.init_date, m.month FROM v_register r JOIN
  (SELECT DISTINCT CAST(date_trunc('month', init_date) AS DATE) AS month FROM v_register) m
ON r.init_date <= last_day(m.month) AND r.disc_date >= m.month""")
def _(spark, d):
    spans = view(spark, d, "v_register").select("ID", "init_date", "disc_date")
    observed = spans.select(F.trunc("init_date", "MM").alias("month"))
    return J.overlap_months(spans, "init_date", "disc_date", observed, "month").drop("disc_date")


@query("join_interval_pairs", """
WITH l AS (SELECT l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS s, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS e FROM lineitem)
SELECT r.l_suppkey, count(*) AS pairs, CAST(sum(date_diff('day', greatest(r.s, a.s), least(r.e, a.e)) + 1) AS BIGINT) AS days
FROM l r JOIN l a ON r.l_suppkey = a.l_suppkey AND r.s <= a.e AND a.s <= r.e
WHERE r.l_returnflag = 'R' AND a.l_returnflag = 'A' GROUP BY 1""")
def _(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_suppkey", "l_returnflag", F.to_date("l_shipdate").alias("s"), F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).alias("e")
    )
    returned, accepted = (lines.filter(F.col("l_returnflag") == f).drop("l_returnflag") for f in "RA")
    pairs = J.overlap_join(returned, accepted, ["l_suppkey"], ("s", "e"))
    shared = F.datediff(F.least("e", "right_e"), F.greatest("s", "right_s")) + 1
    return pairs.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("pairs"), F.sum(shared).alias("days"))


@query("join_asof_forward", """
SELECT v.visit_id, (SELECT min(rx_order_date) FROM v_rx r WHERE r.id_from_site IS NOT DISTINCT FROM v.id_from_site
  AND r.rx_order_date >= v.encounter_date) AS nearest_rx FROM v_visit v""")
def _(spark, d):
    visits = view(spark, d, "v_visit").select("id_from_site", "encounter_date", "visit_id")
    rx = view(spark, d, "v_rx").select("id_from_site", "rx_order_date")
    how = (["id_from_site"], "encounter_date", "rx_order_date", "visit_id")
    hot = find_hot(J.asof_hot_input(visits, rx, *how), ["id_from_site"], ["_date", "_side", "_id"])
    return J.asof_forward(visits, rx, *how, "nearest_rx", hot).select("visit_id", "nearest_rx")


_EVEN = "SELECT program_id FROM v_site WHERE n_regionkey IN (0, 2)"


@query("join_conditional_anti", f"""
SELECT date, program_id, variable, round(value, 6) AS value FROM v_long WHERE starts_with(variable, 'imat_') OR program_id NOT IN ({_EVEN})
UNION ALL SELECT date, program_id, variable, 1.0 FROM v_long WHERE program_id IN ({_EVEN}) AND variable = 'reaim_b1'""")
def _(spark, d):
    base = view(spark, d, "v_long").select("date", "program_id", "variable", "value")
    listed = S.small_side(view(spark, d, "v_site").filter("n_regionkey in (0, 2)").select("program_id"))
    manual = base.filter("variable = 'reaim_b1'").join(listed, "program_id", "left_semi").withColumn("value", F.lit(1.0))
    return r6(J.replace_by_key(base, manual.select(base.columns), "program_id", "imat_"))


@query("join_left_semi_cohort", """
SELECT rx_id, rx_order_date FROM (SELECT *, (SELECT min(encounter_date) FROM v_visit v WHERE v.id_from_site IS NOT DISTINCT FROM r.id_from_site
  AND encounter_date >= DATE '1998-01-01') AS entry FROM v_rx r) WHERE rx_order_date >= entry""")
def _(spark, d):
    visits = view(spark, d, "v_visit").filter("encounter_date >= date '1998-01-01'")
    cohort = visits.groupBy("id_from_site").agg(F.min("encounter_date").alias("entry"))
    return J.restrict_to_cohort(view(spark, d, "v_rx"), cohort, "id_from_site", "rx_order_date", "entry").select("rx_id", "rx_order_date")


@query("sort_multi_key", "SELECT program_id, date, c1_n FROM v_month ORDER BY c1_n NULLS LAST, program_id, date")
def _(spark, d):
    return view(spark, d, "v_month").select("program_id", "date", "c1_n").orderBy(
        F.col("c1_n").asc_nulls_last(), "program_id", "date"
    )


@query("sort_custom_order", """
SELECT date, program_id, variable, list_position(['reaim_c8', 'reaim_c7', 'reaim_c6'], variable) AS position FROM v_long
WHERE variable IN ('reaim_c6', 'reaim_c7', 'reaim_c8')""")
def _(spark, d):
    labels = fixed.REFERRAL_VARIABLES[::-1]
    rows = view(spark, d, "v_long").filter(F.col("variable").isin(labels)).select("date", "program_id", "variable")
    return rows.withColumn("position", list_position(F.col("variable"), labels)).orderBy("position", "program_id", "date")


@query("set_union_fill", """
SELECT response_id, cdi_outer_1, NULL::INT AS cdi_outer_3, 'SUD' AS type FROM v_survey WHERE type = 'SUD'
UNION ALL SELECT response_id, NULL, cdi_outer_3, 'PC' FROM v_survey WHERE type = 'PC'""")
def _(spark, d):
    df = view(spark, d, "v_survey")
    return S.stack_tagged({
        "SUD": df.filter("type = 'SUD'").select("response_id", "cdi_outer_1"),
        "PC": df.filter("type = 'PC'").select("response_id", "cdi_outer_3"),
    }, "type")


@query("set_union_strict", "SELECT program_id, b1 AS n FROM v_month UNION ALL SELECT program_id, b2 FROM v_month")
def _(spark, d):
    df = view(spark, d, "v_month")
    return S.stack(df.select("program_id", F.col("b1").alias("n")), df.select(F.col("b2").alias("n"), "program_id"))


@query("set_union_distinct", """
SELECT id_from_site, date_trunc('month', encounter_date)::DATE AS month FROM v_visit
UNION SELECT id_from_site, date_trunc('month', rx_order_date)::DATE FROM v_rx""")
def _(spark, d):
    visits = view(spark, d, "v_visit").select("id_from_site", F.trunc("encounter_date", "MM").alias("month"))
    rx = view(spark, d, "v_rx").select("id_from_site", F.trunc("rx_order_date", "MM").alias("month"))
    return S.stack(visits, rx).distinct()
