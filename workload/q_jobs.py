"""Queries: whole jobs from exports to measures, tables and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelens import fixed
from carelens.operators.ordered import find_hot
from carelens.operators.select import drop_withdrawn, small_side
from carelens.plans import archive, baseline, combine, integration, reach, registry, reports, summaries, survey, tables
from carelens.plans import patients as P
from workload.q_groups import FLAGS_SQL, IDS_SQL, REGISTER_SQL, SCORED
from workload.registry import query, r6
from workload.views import BASE_MONTHS, BASE_VARS, COHORT_START, IMAT_ITEMS, IMAT_MEANS, view

_ACTIVE = SCORED + ", active AS (SELECT * FROM scored WHERE imp_support <> 5)"
LAST_MONTH = "2000-09-01"
IMAT_DATE = "2000-04-01"


def active(spark, d, ids=("program_id", "type"), counted=True):
    """Scored answers of sites still in the study, equal answers counted."""
    return survey.score_answers(drop_withdrawn(view(spark, d, "v_survey")), list(ids), counted=counted)


@query("job_survey_scoring", f"""
WITH {_ACTIVE}
SELECT date, program_id, type, CASE WHEN grouping(subscale) = 1 THEN 'cdi_9total' ELSE subscale END AS subscale,
  count(*) FILTER (cat = 'barriers') AS barriers, count(*) FILTER (cat = 'neutral') AS neutral,
  count(*) FILTER (cat = 'facilitators') AS facilitators
FROM active GROUP BY GROUPING SETS ((date, program_id, type, subscale), (date, program_id, type))""")
def _(spark, d):
    return survey.survey_scoring(view(spark, d, "v_survey"))


_BASE = " UNION ALL ".join(
    f"SELECT program_id, type, DATE '2022-{k + 1:02d}-01' AS date, "
    + ", ".join(f"TRY_CAST(demo_moud_{v}_{m} AS DOUBLE) AS {v}" for v in BASE_VARS)
    + " FROM v_baseline WHERE imp_support <> 5"
    for k, m in enumerate(BASE_MONTHS)
)


@query("job_baseline_reaim", f"""
WITH w AS ({_BASE}), f AS (SELECT program_id, type, date, a1, b1 AS b2, b2 AS b1, b3,
  CASE WHEN b3 IS NULL AND b4 IS NULL THEN NULL ELSE ifnull(b3, 0) + ifnull(b4, 0) END AS b4 FROM w),
g AS (SELECT *, CASE WHEN b1 = 0 THEN NULL WHEN b4 > b1 THEN 100 ELSE round(b4 / b1 * 100, 6) END AS b4p FROM f)
SELECT date, program_id, type, unnest(['reaim_a1','reaim_b1','reaim_b2','reaim_b3','reaim_b4','reaim_b4p']) AS variable,
  unnest([a1, b1, b2, b3, b4, b4p]) AS value FROM g""")
def _(spark, d):
    return r6(baseline.baseline_reaim(view(spark, d, "v_baseline")))


@query("job_baseline_imat", " UNION ALL ".join(
    f"SELECT DATE '1998-09-01' AS date, v.program_id, v.type, '{c.removesuffix('_mean')}' AS variable, round({c}, 6) AS value "
    f"FROM v_imat v JOIN v_site s USING (program_id) WHERE s.imp_support <> 5 AND event_name = 'sep_1998_arm_1' AND {c} IS NOT NULL"
    for c in IMAT_MEANS))
def _(spark, d):
    sites = view(spark, d, "v_site").select("program_id", "imp_support")
    export = view(spark, d, "v_imat").join(sites, "program_id")
    return r6(baseline.baseline_imat(export, "sep_1998_arm_1"))


@query("job_program_info", """
SELECT program_id, CASE demo_goal WHEN 1 THEN 'Start MOUD' WHEN 2 THEN 'Expand MOUD' END AS demo_goal, type AS site_type,
  CASE WHEN type = 'PC' THEN 'Outpatient' WHEN regexp_matches(demo_level_of_care, '[12]') AND regexp_matches(demo_level_of_care, '[345]') THEN 'Both'
    WHEN regexp_matches(demo_level_of_care, '[12]') THEN 'Outpatient' ELSE 'Inpatient' END AS care_level
FROM v_site WHERE imp_support <> 5""")
def _(spark, d):
    sites = view(spark, d, "v_site")
    return baseline.program_info(sites.filter("type = 'SUD'"), sites.filter("type = 'PC'"))


_CLEAN = """filled AS (SELECT * EXCLUDE (imp_support), last_value(imp_support IGNORE NULLS) OVER (PARTITION BY program_id ORDER BY row_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS imp_support,
    strptime('01_' || event_name[1:8], '%d_%b_%Y')::DATE AS survey_month FROM v_registry),
clean AS (SELECT * FROM filled WHERE imp_support <> 5 AND form_complete = 2),
blocks AS (SELECT program_id, survey_month, pr_moud_prescriber_1 AS prescriber, pr_moud_prescriber_mo_1 AS months, pr_moud_prescriber_relat_1 AS relat FROM clean
  UNION ALL SELECT program_id, survey_month, pr_moud_prescriber_2, pr_moud_prescriber_mo_2, pr_moud_prescriber_relat_2 FROM clean),
provider AS (SELECT program_id, prescriber, relat, (survey_month - to_months(4 - CAST(code AS INT)))::DATE AS month
  FROM (SELECT *, unnest(string_split(months, ',')) AS code FROM blocks WHERE prescriber <> ''))"""


def clean_registry(spark, d):
    export = view(spark, d, "v_registry")
    return registry.registry_cleanup(export, ["row_id"], find_hot(export, ["program_id"], ["row_id"]))


@query("job_registry_cleanup", f"""
WITH {_CLEAN} SELECT row_id, program_id, survey_month, imp_support, nullif(pr_moud_prescriber_1, '') AS pr_moud_prescriber_1,
  nullif(pr_id, '') AS pr_id FROM clean""")
def _(spark, d):
    return clean_registry(spark, d).select(
        "row_id", "program_id", "survey_month", "imp_support", "pr_moud_prescriber_1", "pr_id"
    )


@query("job_provider_months", f"""
WITH {_CLEAN} SELECT program_id, month, count(*) AS "A1", nullif(count(*) FILTER (relat = 2), 0) AS "A2" FROM provider GROUP BY ALL""")
def _(spark, d):
    return registry.provider_months(clean_registry(spark, d))


@query("job_patient_rows", f"WITH {_CLEAN} SELECT row_id, program_id, pr_id, round(pr_amount, 6) AS pr_amount FROM clean WHERE pr_id <> ''")
def _(spark, d):
    return r6(registry.patient_rows(clean_registry(spark, d)).select("row_id", "program_id", "pr_id", "pr_amount"))


_ANY = "coalesce(" + ", ".join([*IMAT_ITEMS, *IMAT_MEANS]) + ") IS NOT NULL"
_IMAT_MONTH = "strptime('01_' || event_name[1:8], '%d_%b_%Y')::DATE AS date"


@query("job_imat_items", f"""
SELECT program_id, {_IMAT_MONTH}, unnest([{", ".join(f"'{c}'" for c in IMAT_ITEMS)}]) AS variable,
  unnest([{", ".join(IMAT_ITEMS)}]) AS value FROM v_imat WHERE {_ANY}""")
def _(spark, d):
    return integration.imat_items(view(spark, d, "v_imat"))


_SUBSCALES = f"""sub AS (SELECT program_id, {_IMAT_MONTH}, unnest([{", ".join(f"'{c[:-5]}'" for c in IMAT_MEANS)}, 'imat_s1']) AS variable,
  unnest([{", ".join(IMAT_MEANS)}, list_avg([{", ".join(fixed.LOW_BARRIER_ITEMS)}])]) AS value FROM v_imat WHERE {_ANY})"""


@query("job_imat_subscales", f"WITH {_SUBSCALES} SELECT program_id, date, variable, round(value, 6) AS value FROM sub")
def _(spark, d):
    return r6(integration.imat_subscales(view(spark, d, "v_imat")))


# ---- patients

def extracts(spark, d):
    decoder = view(spark, d, "v_site").select("site_name", "program_id")
    return view(spark, d, "v_visit"), view(spark, d, "v_rx"), small_side(decoder)


def flagged(spark, d):
    visits, rx, decoder = extracts(spark, d)
    balance = P.measure_balance(visits, rx, decoder)
    ids = P.patient_ids(visits, decoder, balance)
    rx_flags = P.prescription_flags(rx, ids, balance)
    return ids, rx_flags, P.visit_flags(visits, ids, rx_flags, balance), balance


def study(spark, d):
    return reach.build_study(*extracts(spark, d), start=COHORT_START)


@query("job_patient_ids", f"WITH {IDS_SQL} SELECT id_from_site, pr_id FROM ids")
def _(spark, d):
    return flagged(spark, d)[0]


@query("job_prescription_flags", f"""
WITH {IDS_SQL}, {FLAGS_SQL} SELECT rx_id, pr_id, 'id' || left(pr_id, 2) AS program_id, date_trunc('month', rx_order_date)::DATE AS month,
  est_rx_days, is_restart, is_break FROM flagged LEFT JOIN ids ON flagged.id_from_site IS NOT DISTINCT FROM ids.id_from_site""")
def _(spark, d):
    cols = ["rx_id", "pr_id", "program_id", "month", "est_rx_days", "is_restart", "is_break"]
    return flagged(spark, d)[1].select(*cols)


VISITS_SQL = """starts AS (SELECT v.*, pr_id, i.program_id, date_trunc('month', v.encounter_date)::DATE AS month,
    v.visit_id = first_value(v.visit_id) OVER (PARTITION BY v.id_from_site ORDER BY v.encounter_date, v.visit_id) AS is_start,
    EXISTS (SELECT 1 FROM flagged f WHERE f.is_restart AND f.id_from_site IS NOT DISTINCT FROM v.id_from_site AND f.rx_order_date = v.encounter_date) AS is_restart
  FROM v_visit v LEFT JOIN ids i ON i.id_from_site IS NOT DISTINCT FROM v.id_from_site)"""


@query("job_visit_flags", f"WITH {IDS_SQL}, {FLAGS_SQL}, {VISITS_SQL} SELECT visit_id, pr_id, program_id, month, is_start, is_restart FROM starts")
def _(spark, d):
    return flagged(spark, d)[2].select("visit_id", "pr_id", "program_id", "month", "is_start", "is_restart")


COHORT_SQL = f"""cohort AS (SELECT id_from_site, min(encounter_date) AS entry FROM starts
  WHERE (is_start OR is_restart) AND encounter_date >= DATE '{COHORT_START}' GROUP BY 1)"""


@query("job_study_cohort", f"WITH {IDS_SQL}, {FLAGS_SQL}, {VISITS_SQL}, {COHORT_SQL} SELECT id_from_site, entry AS first_study_date FROM cohort")
def _(spark, d):
    return P.study_cohort(flagged(spark, d)[2], COHORT_START)


STUDY_SQL = f"""{IDS_SQL}, {FLAGS_SQL}, {VISITS_SQL}, {COHORT_SQL},
s_lag AS (SELECT l.* EXCLUDE (rn), pr_id, i.program_id, row_number() OVER (PARTITION BY l.id_from_site ORDER BY rx_order_date, rx_id) AS rn
  FROM lagged l JOIN cohort c ON c.id_from_site IS NOT DISTINCT FROM l.id_from_site AND l.rx_order_date >= c.entry JOIN ids i ON i.id_from_site IS NOT DISTINCT FROM l.id_from_site),
s_rx AS (SELECT b.*, NOT (b.rn = 1 OR b.rx_order_date - a.rx_order_date < 34
    OR ifnull(b.rx_order_date - a.rx_order_date < a.est_rx_days * (a.rx_num_refills + 1), false)) AS is_restart
  FROM s_lag b LEFT JOIN s_lag a ON a.id_from_site IS NOT DISTINCT FROM b.id_from_site AND a.rn = b.rn - 1),
s_brk AS (SELECT a.*, ifnull(b.is_restart, true) AS is_break FROM s_rx a LEFT JOIN s_rx b ON a.id_from_site IS NOT DISTINCT FROM b.id_from_site AND b.rn = a.rn + 1),
s_vis AS (SELECT * EXCLUDE (is_start, is_restart, n), n = 1 AS is_start, is_restart AND n > 1 AS is_restart
  FROM (SELECT s.*, row_number() OVER (PARTITION BY s.id_from_site ORDER BY encounter_date, visit_id) AS n
        FROM starts s JOIN cohort c ON c.id_from_site IS NOT DISTINCT FROM s.id_from_site AND s.encounter_date >= c.entry)),
s_open AS (SELECT id_from_site, pr_id, program_id, rx_order_date AS start_date, row_number() OVER (PARTITION BY id_from_site ORDER BY rn) AS k
  FROM s_brk WHERE rn = 1 OR is_restart),
s_close AS (SELECT id_from_site, CASE WHEN date_diff('day', DATE '1970-01-01', rx_order_date) + floor(est_rx_days) BETWEEN -719162 AND 2932896 THEN CAST(rx_order_date + CAST(floor(est_rx_days) AS INT) AS DATE) END AS end_date, row_number() OVER (PARTITION BY id_from_site ORDER BY rn) AS k
  FROM s_brk WHERE is_break),
s_span AS (SELECT o.*, c.end_date FROM s_open o JOIN s_close c ON o.id_from_site IS NOT DISTINCT FROM c.id_from_site AND o.k = c.k),
s_month AS (SELECT DISTINCT date_trunc('month', rx_order_date)::DATE AS month FROM s_brk),
on_tx AS (SELECT s.*, m.month FROM s_span s JOIN s_month m ON s.start_date <= last_day(m.month) AND s.end_date >= m.month)"""


@query("job_study_events", f"""
WITH {STUDY_SQL} SELECT 'rx' AS kind, rx_id AS event_id, rx_order_date AS day, pr_id, is_restart, is_break AS is_edge FROM s_brk
UNION ALL SELECT 'visit', visit_id, encounter_date, pr_id, is_restart, is_start FROM s_vis""")
def _(spark, d):
    s = study(spark, d)
    rx = s.rx.select(F.lit("rx").alias("kind"), F.col("rx_id").alias("event_id"), F.col("rx_order_date").alias("day"),
                     "pr_id", "is_restart", F.col("is_break").alias("is_edge"))
    visits = s.visits.select(F.lit("visit").alias("kind"), F.col("visit_id").alias("event_id"),
                             F.col("encounter_date").alias("day"), "pr_id", "is_restart", F.col("is_start").alias("is_edge"))
    return rx.unionByName(visits)


@query("job_treatment_months", f"WITH {STUDY_SQL} SELECT pr_id, program_id, start_date, CAST(end_date AS DATE) AS end_date, month FROM on_tx")
def _(spark, d):
    return study(spark, d).months.select("pr_id", "program_id", "start_date", "end_date", "month")


def _grid(counts: str) -> str:
    """Zero fill over the sites and months of one measure."""
    return f"""m AS ({counts}), full_grid AS (SELECT a.program_id, a.variable, b.date, ifnull(m.value, 0) AS value
  FROM (SELECT DISTINCT program_id, variable FROM m) a CROSS JOIN (SELECT DISTINCT date FROM m) b LEFT JOIN m ON m.program_id IS NOT DISTINCT FROM a.program_id AND m.variable = a.variable AND m.date = b.date)"""


A1_SQL = """SELECT s.program_id, 'reaim_a1' AS variable, date_trunc('month', rx_order_date)::DATE AS date,
  count(DISTINCT ifnull(rx_provider, '?'))::DOUBLE AS value FROM s_brk r JOIN v_site s ON s.site_name = r.rx_site_name GROUP BY ALL"""
B1_SQL = """SELECT program_id, 'reaim_b1' AS variable, month AS date, count(DISTINCT coalesce(id_from_site, -1))::DOUBLE AS value FROM
  (SELECT program_id, month, id_from_site FROM s_vis WHERE is_start UNION ALL SELECT program_id, month, id_from_site FROM on_tx) GROUP BY ALL"""
B2_SQL = """SELECT program_id, 'reaim_b2' AS variable, month AS date, count(DISTINCT coalesce(id_from_site, -1))::DOUBLE AS value FROM s_vis
  WHERE is_start OR is_restart GROUP BY ALL"""


def _pct(count: str, base: str, n: str, p: str) -> str:
    """Both rows of a measure with its percent; the base is looked up where the measure has a count."""
    return f"""SELECT c.program_id, unnest(['{n}', '{p}']) AS variable, c.date, unnest([c.value, c.value / b.value * 100]) AS value
  FROM ({count}) c LEFT JOIN ({base}) b ON b.program_id IS NOT DISTINCT FROM c.program_id AND b.date = c.date"""


B4_SQL = _pct("SELECT program_id, month AS date, count(DISTINCT coalesce(id_from_site, -1))::DOUBLE AS value FROM on_tx GROUP BY ALL", B1_SQL, "reaim_b4", "reaim_b4p")
C1_SQL = _pct(
    """SELECT program_id, month AS date, count(*)::DOUBLE AS value FROM s_vis v WHERE (is_start OR is_restart) AND EXISTS (SELECT 1 FROM s_brk r
  WHERE r.id_from_site IS NOT DISTINCT FROM v.id_from_site AND r.rx_order_date BETWEEN v.encounter_date AND v.encounter_date + 3) GROUP BY ALL""",
    B2_SQL, "reaim_c1_n", "reaim_c1p",
)
_LONG_OUT = "SELECT program_id, variable, date, round(value, 6) AS value FROM full_grid"


@query("job_a1_prescribers", f"WITH {STUDY_SQL}, {_grid(A1_SQL)} {_LONG_OUT}")
def _(spark, d):
    return r6(reach.a1_prescribers(study(spark, d)))


@query("job_b1_patients", f"WITH {STUDY_SQL}, {_grid(B1_SQL)} {_LONG_OUT}")
def _(spark, d):
    return r6(reach.b1_patients(study(spark, d)))


@query("job_b2_new_patients", f"WITH {STUDY_SQL}, {_grid(B2_SQL)} {_LONG_OUT}")
def _(spark, d):
    return r6(reach.b2_new_patients(study(spark, d)))


@query("job_b4_on_treatment", f"WITH {STUDY_SQL}, {_grid(B4_SQL)} {_LONG_OUT}")
def _(spark, d):
    return r6(reach.b4_on_treatment(study(spark, d)))


@query("job_c1_within_72h", f"WITH {STUDY_SQL}, {_grid(C1_SQL)} {_LONG_OUT}")
def _(spark, d):
    return r6(reach.c1_fast_access(study(spark, d)))


def _named(counts: str, n: int) -> str:
    return _grid(counts).replace("m AS (", f"m{n} AS (", 1).replace("full_grid", f"g{n}").replace("FROM m)", f"FROM m{n})").replace(
        "LEFT JOIN m ON", f"LEFT JOIN m{n} ON").replace(" m.program_id", f" m{n}.program_id").replace(" m.variable", f" m{n}.variable").replace(" m.date", f" m{n}.date").replace("ifnull(m.value", f"ifnull(m{n}.value")


_ALL5 = [A1_SQL, B1_SQL, B2_SQL, B4_SQL, C1_SQL]


@query("job_measures_wide", f"""
WITH {STUDY_SQL}, {", ".join(_named(s, n) for n, s in enumerate(_ALL5))},
stacked AS ({" UNION ALL ".join(f"SELECT * FROM g{n}" for n in range(5))})
SELECT program_id, date, {", ".join(f"round(max(value) FILTER (variable = '{v}'), 6) AS {v}" for v in reach.MEASURES)}
FROM stacked GROUP BY program_id, date""")
def _(spark, d):
    return r6(reach.measures_wide(study(spark, d)))


# ---- combination

@query("job_combined_long", f"""
WITH {_SUBSCALES} SELECT date, program_id, variable, round(value, 6) AS value, CASE WHEN CAST(substr(program_id, 3) AS INT) < 50 THEN 'SUD' ELSE 'PC' END AS type
FROM (SELECT date, program_id, variable, value FROM v_long UNION ALL SELECT date, program_id, variable, value FROM sub)""")
def _(spark, d):
    return r6(combine.combined_long(
        view(spark, d, "v_long"), integration.imat_subscales(view(spark, d, "v_imat"))
    ))


@query("job_manual_override", """
WITH manual AS (SELECT date, program_id, variable, value + 1 AS value, type FROM v_long WHERE variable IN ('reaim_b1', 'reaim_b2', 'reaim_b5p')
  AND program_id IN (SELECT DISTINCT program_id FROM v_long WHERE variable = 'reaim_b5p'))
SELECT date, program_id, variable, round(value, 6) AS value, type FROM manual UNION ALL
SELECT date, program_id, variable, round(value, 6), type FROM v_long l WHERE starts_with(variable, 'imat_')
  OR NOT EXISTS (SELECT 1 FROM manual m WHERE m.program_id = l.program_id)""")
def _(spark, d):
    long = view(spark, d, "v_long")
    newer = long.filter("variable = 'reaim_b5p'").select("program_id").distinct()
    manual = long.filter(F.col("variable").isin("reaim_b1", "reaim_b2", "reaim_b5p")).join(newer, "program_id", "left_semi")
    return r6(combine.manual_override(long, manual.withColumn("value", F.col("value") + 1)))


_C1_VARS = ["reaim_b1", "reaim_b2", "reaim_b4", "reaim_c1"]


@query("job_c1_correction", """
WITH w AS (SELECT strftime(date, '%b-%y') AS date, program_id, type, b1, b2, b4, c1_n FROM v_month
  WHERE strftime(date, '%b-%y') IN ('Sep-98', 'Oct-98', 'Nov-98', 'Dec-98', 'Jan-99', 'Feb-99')),
f AS (SELECT * EXCLUDE (c1_n), CASE WHEN date IN ('Sep-98', 'Oct-98', 'Nov-98') THEN CASE WHEN b4 > 0 THEN c1_n / 100 * b2 / b4 END ELSE c1_n END AS c1 FROM w)
SELECT date, program_id, type, unnest(['reaim_b1', 'reaim_b2', 'reaim_b4', 'reaim_c1']) AS variable,
  unnest([b1::DOUBLE, b2, b4, round(c1, 6)]) AS final_value FROM f""")
def _(spark, d):
    long = view(spark, d, "v_long").withColumn("variable", F.regexp_replace("variable", "^reaim_c1_n$", "reaim_c1"))
    manual = long.filter(F.col("variable").isin(_C1_VARS)).select(
        F.date_format("date", "MMM-yy").alias("date"), "program_id", "type", "variable",
        F.col("value").cast("string").alias("final_value"),
    )
    return r6(combine.c1_correction(manual, _C1_VARS, ["Sep-98", "Oct-98", "Nov-98"], ["Dec-98", "Jan-99", "Feb-99"]))


# ---- survey summaries

_GROUP = "CASE WHEN CAST(substr(program_id, 3) AS INT) BETWEEN 53 AND 62 THEN 'PC_group1' ELSE program_id END"
_SITES = f"""{_ACTIVE}, sites AS (SELECT program_id, type, {_GROUP} AS site_group, subscale, avg(raw_value) AS subscale_val FROM active GROUP BY ALL),
totals AS (SELECT program_id, type, {_GROUP} AS site_group, avg(raw_value) AS total_val FROM active GROUP BY ALL)"""


def grouped(spark, d):
    return survey.with_site_group(active(spark, d))


@query("job_site_group_collapse", f"""
WITH {_ACTIVE} SELECT program_id, count(*) AS n, round(avg(raw_value), 6) AS mean FROM (
  SELECT program_id, raw_value FROM active WHERE CAST(substr(program_id, 3) AS INT) NOT BETWEEN 53 AND 62
  UNION ALL SELECT 'id89', avg(raw_value) FROM active WHERE CAST(substr(program_id, 3) AS INT) BETWEEN 53 AND 62 GROUP BY item, q_num, subscale, date)
GROUP BY program_id""")
def _(spark, d):
    answers = survey.with_site_group(active(spark, d, ["program_id", "type", "date"], counted=False))
    merged = survey.collapse_sites(answers, fixed.COLLAPSED_SITES, "id89", "PC_group1")
    return r6(merged.groupBy("program_id").agg(F.count(F.lit(1)).alias("n"), F.avg("raw_value").alias("mean")))


@query("job_site_distribution", f"""
WITH {_SITES} SELECT program_id, type, site_group, subscale, round(subscale_val, 6) AS subscale_val FROM sites WHERE subscale_val IS NOT NULL
UNION ALL SELECT program_id, type, site_group, 'total', round(total_val, 6) FROM totals""")
def _(spark, d):
    return r6(summaries.site_distribution(grouped(spark, d)))


FACTORS_SQL = f"""{_ACTIVE}, w AS (SELECT program_id, date, {", ".join(f"avg(raw_value) FILTER (q_num = '{q}') AS cdi_{q}" for q in fixed.FACTOR_QUESTIONS)}
  FROM active WHERE q_num IN ({", ".join(f"'{q}'" for q in fixed.FACTOR_QUESTIONS)}) GROUP BY ALL),
i AS (SELECT program_id, {_IMAT_MONTH}, avg([1.0, 2.5, 4.0, 5.5, 7.0][imat_d5_6]::DOUBLE) AS imat_d5_6 FROM v_imat GROUP BY ALL),
j AS (SELECT w.*, imat_d5_6 FROM w LEFT JOIN i USING (program_id, date) WHERE CAST(substr(program_id, 3) AS INT) NOT BETWEEN 54 AND 62)"""


@query("job_community_factors", f"""
WITH {FACTORS_SQL}
SELECT {", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_sd" for c in summaries.factor_columns())} FROM j
WHERE date = DATE '{LAST_MONTH}'""")
def _(spark, d):
    return r6(summaries.factor_summary(factors(spark, d, LAST_MONTH)))


def factors(spark, d, date=None):
    sites = view(spark, d, "v_site")
    info = baseline.program_info(sites.filter("type = 'SUD'"), sites.filter("type = 'PC'"))
    answers = active(spark, d, ["program_id", "type", "date"])
    return summaries.community_factors(answers, integration.imat_items(view(spark, d, "v_imat")), info, date)


# ---- survey tables

def _labels() -> str:
    names = ", ".join(f"({n}, '{code}', '{name}')" for n, (code, name) in enumerate(fixed.DISPLAY_NAMES, 1))
    return f"names AS (SELECT * FROM (VALUES {names}) t(position, code, fmt_name))"


def _means(group: str) -> str:
    return f"""SELECT {group}, avg(oriented_value) FILTER (type = 'SUD') AS "SUD_mean_v", avg(oriented_value) FILTER (type = 'PC') AS "PC_mean_v",
  avg(oriented_value) AS all_mean_v FROM active"""


def _cells(group: str) -> str:
    return f"""SELECT program_id, type, {group} AS grp, sum(CASE cat WHEN 'barriers' THEN share ELSE 0 END) AS b, sum(CASE cat WHEN 'facilitators' THEN share ELSE 0 END) AS f
  FROM (SELECT program_id, type, {group}, cat, count(*) / (sum(count(*)) OVER (PARTITION BY program_id, type, {group})) AS share FROM active GROUP BY 1, 2, 3, 4)
  WHERE cat <> 'neutral' GROUP BY 1, 2, 3"""


_SHARES = ", ".join(
    f"""avg({c}) FILTER (type = '{t}') AS "{t}_{n}" """ for t in ("SUD", "PC") for c, n in (("b", "barriers_percent"), ("f", "facilitators_percent"))
) + ", avg(b) AS all_barriers_percent, avg(f) AS all_facilitators_percent"
_COLS = [f"{t}_{c}" for t in ("SUD", "PC", "all") for c in ("mean_v", "barriers_percent", "facilitators_percent")]
_ROUNDED = ", ".join(f'round("{c}", 6) AS "{c}"' for c in _COLS)


def _table_sql(group: str) -> str:
    return f"""WITH {_ACTIVE}, {_labels()}, cells AS ({_cells(group)}), lev AS ({_cells("level")}),
body AS (SELECT * FROM ({_means(group + " AS grp")} GROUP BY {group}) m LEFT JOIN (SELECT grp, {_SHARES} FROM cells GROUP BY grp) s USING (grp)
  UNION ALL BY NAME SELECT * FROM ({_means("'total' AS grp")}) CROSS JOIN (SELECT {_SHARES} FROM lev))
SELECT position, fmt_name, {_ROUNDED} FROM body LEFT JOIN names ON code = grp"""


@query("job_subscale_table", _table_sql("subscale"))
def _(spark, d):
    return r6(tables.subscale_table(active(spark, d)))


@query("job_level_table", _table_sql("level"))
def _(spark, d):
    return r6(tables.level_table(active(spark, d)))


@query("job_question_table", f"""
WITH {_ACTIVE}, {_labels()}, body AS ({_means("subscale, q_num")} GROUP BY subscale, q_num
  UNION ALL {_means("subscale, 'Subgroup Mean'")} GROUP BY subscale)
SELECT position, fmt_name, q_num, {", ".join(f'round("{t}_mean_v", 6) AS "{t}_mean_v"' for t in ("SUD", "PC", "all"))}
FROM body LEFT JOIN names ON code = subscale""")
def _(spark, d):
    return r6(tables.question_table(active(spark, d)))


# ---- selections and reports

REGRESSION_SQL = f"""{_ACTIVE}, m AS (SELECT program_id, avg(raw_value) AS mean_likert, {", ".join(
    f"round_even(count(*) FILTER (cat = '{c}') / count(*) * 100, 2) AS {c}" for c in fixed.CATEGORIES)} FROM active GROUP BY program_id),
inputs AS (SELECT m.program_id, mean_likert, barriers, neutral, facilitators, b4::DOUBLE AS "count_MOUD", b4 / b1 * 100 AS "pct_MOUD"
  FROM m LEFT JOIN (SELECT * FROM v_month WHERE date = DATE '{LAST_MONTH}') o ON o.program_id = m.program_id)"""


@query("job_regression_inputs", f"""
WITH {REGRESSION_SQL} SELECT program_id, round(mean_likert, 6) AS mean_likert, barriers, neutral, facilitators, "count_MOUD",
  round("pct_MOUD", 6) AS "pct_MOUD" FROM inputs""")
def _(spark, d):
    return r6(regression_inputs(spark, d))


def regression_inputs(spark, d):
    return summaries.regression_inputs(active(spark, d), view(spark, d, "v_long"), LAST_MONTH)


@query("job_interview_table", f"""
WITH {_ACTIVE}, q AS (SELECT program_id, avg(raw_value) AS mean_system FROM active WHERE strpos(item, 'outer') > 0 GROUP BY 1),
info AS (SELECT * FROM v_site WHERE imp_support <> 5), l AS (SELECT * FROM v_long QUALIFY date = max(date) OVER (PARTITION BY program_id, variable))
SELECT coalesce(i.program_id, q.program_id) AS program_id, CASE demo_goal WHEN 1 THEN 'Start MOUD' WHEN 2 THEN 'Expand MOUD' END AS demo_goal, i.type AS site_type,
  CASE WHEN i.type = 'PC' THEN 'Outpatient' WHEN regexp_matches(demo_level_of_care, '[12]') AND regexp_matches(demo_level_of_care, '[345]') THEN 'Both'
    WHEN regexp_matches(demo_level_of_care, '[12]') THEN 'Outpatient' WHEN i.type IS NOT NULL THEN 'Inpatient' END AS care_level,
  {", ".join(f"round((SELECT value FROM l WHERE l.program_id = i.program_id AND variable = '{v}'), 6) AS {v}" for v in fixed.INTERVIEW_VARIABLES)},
  round(mean_system, 6) AS "mean_system_CDI" FROM info i FULL JOIN q ON q.program_id = i.program_id""")
def _(spark, d):
    sites = view(spark, d, "v_site")
    info = baseline.program_info(sites.filter("type = 'SUD'"), sites.filter("type = 'PC'"))
    return r6(summaries.interview_table(info, view(spark, d, "v_long"), active(spark, d)))


_DIMS = ", ".join("('{}', '{}')".format(c, n.replace("\n", " ")) for c, n in fixed.DIMENSION_NAMES)


@query("job_imat_averages", f"""
WITH {_SUBSCALES}, top AS (SELECT variable, CASE WHEN CAST(substr(program_id, 3) AS INT) < 50 THEN 'SUD' ELSE 'PC' END AS type, value FROM sub
  WHERE date = (SELECT max(date) FROM sub)),
g AS (SELECT variable, type, CASE WHEN count(*) = count(value) THEN avg(value) END AS mean_v FROM top GROUP BY ALL)
SELECT dims.label AS "Dimension", round_even(max(mean_v) FILTER (type = 'PC'), 2) AS "PC (n=8)", round_even(max(mean_v) FILTER (type = 'SUD'), 2) AS "SUD (n=17)"
FROM g LEFT JOIN (VALUES {_DIMS}) dims(variable, label) USING (variable) GROUP BY g.variable, dims.label""")
def _(spark, d):
    return integration.imat_averages_table(integration.imat_subscales(view(spark, d, "v_imat")))


@query("job_imat_item_summary", f"""
WITH {_SUBSCALES}, items AS (SELECT {_IMAT_MONTH}, unnest([{", ".join(f"'{c}'" for c in IMAT_ITEMS)}]) AS variable,
  unnest([{", ".join(IMAT_ITEMS)}])::DOUBLE AS value FROM v_imat WHERE {_ANY}),
rows AS (SELECT variable, value FROM sub WHERE date = DATE '{IMAT_DATE}' UNION ALL SELECT variable, value FROM items WHERE date = DATE '{IMAT_DATE}'),
g AS (SELECT variable, avg(value) AS m, stddev_samp(value) AS s, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
  count(*) = count(value) AS whole FROM rows GROUP BY variable)
SELECT variable, CASE WHEN whole THEN round(m, 6) END AS mean, CASE WHEN whole THEN round(s, 6) END AS sd,
  CASE WHEN whole THEN round(q1, 6) END AS ptile25, CASE WHEN whole THEN round(q3, 6) END AS ptile75 FROM g""")
def _(spark, d):
    export = view(spark, d, "v_imat")
    return r6(integration.imat_item_summary(
        integration.imat_subscales(export), integration.imat_items(export), IMAT_DATE
    ))


@query("job_report_moud", """
WITH w AS (SELECT *, program_id IN (SELECT program_id FROM v_long WHERE variable = 'reaim_b5p') AS newer FROM v_month),
p AS (SELECT program_id, date, CASE WHEN newer THEN c1_n ELSE b4 END::DOUBLE AS numer, CASE WHEN newer THEN b2 ELSE b1 END::DOUBLE AS denom,
  CASE WHEN newer THEN c1_n / b2 * 100 ELSE b4 / b1 * 100 END AS percent FROM w),
t AS (SELECT program_id, date AS target_x, CASE WHEN percent > 75 THEN 65 WHEN percent IS NOT NULL THEN 85 END AS target_y FROM p
  QUALIFY date = max(date) OVER (PARTITION BY program_id))
SELECT p.program_id, p.date, numer, denom, round(percent, 6) AS percent, target_x, target_y FROM p JOIN t USING (program_id)""")
def _(spark, d):
    return r6(reports.report_moud(view(spark, d, "v_long")))


@query("job_report_72h", """
SELECT program_id, date, c1_n::DOUBLE AS reaim_c1_n, b2::DOUBLE AS reaim_b2,
  round(CASE WHEN b2 = 0 OR c1_n IS NULL THEN 0 WHEN c1_n > b2 THEN 100 ELSE c1_n / b2 * 100 END, 6) AS percent72h,
  ifnull(CAST(c1_n AS VARCHAR), 'NA') || '/' || CAST(b2 AS VARCHAR) AS label FROM v_month""")
def _(spark, d):
    return r6(reports.report_fast_access(view(spark, d, "v_long")))


@query("job_report_linkage", """
SELECT date, program_id, type, variable, value, list_position(['reaim_c8', 'reaim_c7', 'reaim_c6'], variable) AS stack_order,
  ['No referral', 'Referred but did not confirm linkage', 'Referred and linkage confirmed'][list_position(['reaim_c8', 'reaim_c7', 'reaim_c6'], variable)] AS label
FROM v_long WHERE variable IN ('reaim_c6', 'reaim_c7', 'reaim_c8')""")
def _(spark, d):
    return r6(reports.report_linkage(view(spark, d, "v_long")))


@query("job_report_imat", """
SELECT date, variable, round(avg(value), 6) AS value, CASE WHEN strftime(date, '%b-%y') IN ('Sep-98', 'Apr-99') THEN strftime(date, '%b-%y') END AS date_label,
  CASE strftime(date, '%b-%y') WHEN 'Sep-98' THEN 1 WHEN 'Apr-99' THEN 2 END AS date_order
FROM v_long WHERE starts_with(variable, 'imat') GROUP BY date, variable""")
def _(spark, d):
    return r6(reports.report_imat(view(spark, d, "v_long"), "all", ["Sep-98", "Apr-99"]))


# ---- archived

@query("job_demographics", """
SELECT pr_id, pr_ethnicity, concat_ws('_', CASE pr_gender___1 WHEN 1 THEN '1' END, CASE pr_gender___2 WHEN 1 THEN '2' END) AS pr_gender,
  concat_ws('_', CASE pr_race___1 WHEN 1 THEN '1' END, CASE pr_race___2 WHEN 1 THEN '2' END, CASE pr_race___3 WHEN 1 THEN '3' END) AS pr_race
FROM v_patient_form WHERE form_complete = 2 AND pr_new_admit = 1""")
def _(spark, d):
    return registry.demographics(view(spark, d, "v_patient_form"))


@query("job_registry_measures", f"""
WITH r AS ({REGISTER_SQL}), f AS (SELECT b.*, ifnull(b.date - (a.date + CAST(a.duration AS INT)) > 28, false) AS again,
  ifnull(b.date BETWEEN DATE '1998-06-01' AND DATE '1998-06-30', false) AS recent FROM r b LEFT JOIN r a ON a.ID = b.ID AND a.refill = b.refill - 1),
n AS (SELECT count(DISTINCT ifnull(prescriber, '?')) FILTER (recent AND location = 'Onsite') AS a1,
  count(DISTINCT ifnull(prescriber, '?')) FILTER (recent AND location = 'Offsite') AS a2,
  count(DISTINCT ID) FILTER (admit_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-30') AS b1, count(DISTINCT ID) FILTER (disc_date IS NULL) AS b2,
  count(DISTINCT ID) FILTER (recent AND MOUD_type = 'Buprenorphine') AS b3, count(DISTINCT ID) FILTER (recent AND MOUD_type = 'Naltrexone') AS b4,
  count(DISTINCT ID) FILTER (recent AND refill = 0) AS fresh, count(DISTINCT ID) FILTER (recent AND again) AS again,
  count(DISTINCT ID) FILTER (date - diag_date <= 3) AS c1 FROM f)
SELECT a1, a2, a1 + a2 AS a3, b1, b2, b3, b4, b3 + b4 AS b5, round(fresh / (b3 + b4), 6) AS b6, round(again / (b3 + b4), 6) AS b7, c1 FROM n""")
def _(spark, d):
    register = view(spark, d, "v_register")
    return r6(archive.registry_measures(archive.registry_long(register), "1998-06-01"))

