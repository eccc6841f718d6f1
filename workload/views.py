"""Inputs for the registered queries: the given tables seen as clinic exports and extracts.

Each view is one SQL text that Spark and the SQL check both read.  Views use
every row of the tables; missing values and codes come from arithmetic on keys.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from carelens import fixed

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
ITEMS = [item for _, item, _, _ in fixed.SURVEY_ITEMS]
IMAT_ITEMS = [
    "imat_d1_1", "imat_d2_1", "imat_d3_11", "imat_d3_12", "imat_d3_14", "imat_d4_9", "imat_d5_5", "imat_d5_6",
    "imat_d6_1", "imat_d6_2", "imat_d7_3",
]
IMAT_MEANS = [f"imat_d{k}_mean" for k in range(1, 8)] + ["imat_total_mean"]
BASE_VARS = ["a1", "b1", "b2", "b3", "b4"]
BASE_MONTHS = [
    f"{m}2022" for m in ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
]
COHORT_START = "1998-01-01"

_MON = "substr('janfebmaraprmayjunjulaugsepoctnovdec', CAST(3 * month({d}) - 2 AS INT), 3)"


def _likert(i: int, scale: int) -> str:
    return (
        f"CASE WHEN (o.o_orderkey + {i}) % 53 = 0 THEN NULL "
        f"ELSE CAST(1 + (o.o_orderkey * {2 * i + 1} + o.o_custkey * {i} + s.n_nationkey * (o.o_orderkey % 3)) % {scale} AS INT) END"
    )


_JOINED = "{orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN v_site s ON c.c_nationkey = s.n_nationkey"

VIEWS = {
    "v_site": """
SELECT n_nationkey, n_regionkey, 'id' || lpad(CAST(n_nationkey * 3 AS STRING), 2, '0') AS program_id,
       CASE WHEN n_nationkey * 3 < 50 THEN 'SUD' ELSE 'PC' END AS type,
       n_name AS site_name, 1 + n_nationkey % 3 AS demo_goal,
       CASE WHEN n_nationkey % 8 = 0 THEN NULL WHEN n_nationkey % 9 = 0 THEN 5 ELSE 1 END AS imp_support,
       CAST(1 + n_nationkey % 5 AS STRING) || ',' || CAST(1 + n_regionkey AS STRING) AS demo_level_of_care
FROM {nation}""",
    "v_survey": f"""
SELECT o.o_orderkey AS response_id, s.program_id, s.type,
       {_MON.format(d="o.o_orderdate")} || '_' || CAST(year(o.o_orderdate) AS STRING) || '_arm_1' AS event_name,
       CAST(CAST(o.o_orderdate AS DATE) - CAST(day(o.o_orderdate) - 1 AS INT) AS DATE) AS date,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL WHEN o.o_orderkey % 17 = 0 THEN 5 ELSE 1 END AS imp_support,
       {", ".join(f"{_likert(i + 1, 8)} AS {c}" for i, c in enumerate(ITEMS))}
FROM {_JOINED}""",
    "v_imat": f"""
SELECT o.o_orderkey AS response_id, s.program_id, s.type,
       {_MON.format(d="o.o_orderdate")} || '_' || CAST(year(o.o_orderdate) AS STRING) || '_arm_1' AS event_name,
       {", ".join(f"{_likert(i + 1, 5)} AS {c}" for i, c in enumerate(IMAT_ITEMS))},
       CASE WHEN o.o_orderkey % 4 = 0 THEN o.o_orderpriority END AS imat_d1_1_c,
       {", ".join(f"CASE WHEN (o.o_orderkey + {i}) % 9 = 0 THEN NULL ELSE CAST(1 + (o.o_orderkey * {i + 2} + o.o_custkey) % 41 * 0.1 AS DOUBLE) END AS {c}" for i, c in enumerate(IMAT_MEANS))}
FROM {_JOINED}""",
    "v_rx": f"""
SELECT o.o_orderkey AS rx_id, CASE WHEN o.o_orderkey % 97 > 0 THEN o.o_custkey END AS id_from_site, s.site_name AS rx_site_name,
       CAST(o.o_orderdate AS DATE) AS rx_order_date,
       CASE o.o_orderkey % 7 WHEN 0 THEN 'VIVITROL 380mg' WHEN 1 THEN 'SUBLOCADE 300mg' ELSE 'BUPRENORPHINE 8mg' END AS rx_name,
       CASE WHEN o.o_orderkey % 103 = 0 THEN '9999999999 tabs' WHEN o.o_orderkey % 107 = 0 THEN 'as directed'
            WHEN o.o_orderkey % 109 = 0 THEN '999999 tabs' ELSE CASE WHEN o.o_orderkey % 29 = 0 THEN '1,' || lpad(CAST(o.o_orderkey % 1000 AS STRING), 3, '0')
            ELSE CAST(30 + o.o_orderkey % 60 AS STRING) END || ' tabs' END AS rx_quantity,
       CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE CAST(o.o_orderkey % 4 AS INT) END AS rx_num_refills,
       CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE 'p' || CAST(o.o_orderkey % 40 AS STRING) END AS rx_provider
FROM {_JOINED}""",
    "v_visit": f"""
SELECT o.o_orderkey AS visit_id, CASE WHEN o.o_orderkey % 89 > 0 THEN o.o_custkey END AS id_from_site,
       CASE WHEN s.n_nationkey = 7 THEN 'CLOSED CLINIC' ELSE s.site_name END AS site_name,
       CAST(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 11 AS INT) - 6 AS DATE) AS encounter_date
FROM {_JOINED}""",
    "v_month": f"""
SELECT CAST(CAST(o.o_orderdate AS DATE) - CAST(day(o.o_orderdate) - 1 AS INT) AS DATE) AS date, s.program_id, s.type, s.n_regionkey,
       count(*) AS b1, count(DISTINCT o.o_custkey) AS b2,
       CAST(sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS b4,
       CAST(sum(CASE WHEN o.o_orderstatus = 'O' THEN 1 END) AS BIGINT) AS c1_n
FROM {_JOINED}
GROUP BY 1, 2, 3, 4""",
    "v_long": """
SELECT date, program_id, type, variable, value
FROM (SELECT date, program_id, type, n_regionkey, CAST(b1 AS DOUBLE) AS reaim_b1, CAST(b2 AS DOUBLE) AS reaim_b2,
             CAST(b4 AS DOUBLE) AS reaim_b4, CAST(b4 AS DOUBLE) / b1 * 100 AS reaim_b4p, CAST(c1_n AS DOUBLE) AS reaim_c1_n,
             CAST(c1_n AS DOUBLE) AS reaim_b5, CAST(c1_n AS DOUBLE) / b2 * 100 AS reaim_b5p, CAST(b4 AS DOUBLE) AS reaim_c6,
             CAST(c1_n AS DOUBLE) AS reaim_c7, CAST(b1 - b4 AS DOUBLE) AS reaim_c8, CAST(b1 + b4 AS DOUBLE) AS reaim_a1,
             1 + CAST(b1 AS DOUBLE) * 7 % 5 AS imat_d5, 1 + CAST(b2 AS DOUBLE) * 3 % 5 AS imat_d6,
             1 + CAST(b1 + b4 AS DOUBLE) % 5 AS imat_total
      FROM v_month)
UNPIVOT INCLUDE NULLS (value FOR variable IN (reaim_b1, reaim_b2, reaim_b4, reaim_b4p, reaim_c1_n, reaim_b5, reaim_b5p,
        reaim_c6, reaim_c7, reaim_c8, reaim_a1, imat_d5, imat_d6, imat_total))
WHERE n_regionkey = 0 OR variable NOT IN ('reaim_b5', 'reaim_b5p')""",
    "v_registry": f"""
SELECT o.o_orderkey AS row_id, s.program_id, s.type,
       {_MON.format(d="o.o_orderdate")} || '_' || CAST(year(o.o_orderdate) AS STRING) || '_arm_1' AS event_name,
       CASE WHEN o.o_orderkey % 3 = 0 THEN NULL WHEN o.o_orderkey % 17 = 0 THEN 5 ELSE 1 END AS imp_support,
       CAST(1 + o.o_orderkey % 3 AS INT) AS form_complete,
       CASE WHEN o.o_orderkey % 5 = 0 THEN '' ELSE 'p' || CAST(o.o_orderkey % 40 AS STRING) END AS pr_moud_prescriber_1,
       CASE o.o_orderkey % 4 WHEN 0 THEN '1,2,3' WHEN 1 THEN '2,3' WHEN 2 THEN '3' ELSE '1,3' END AS pr_moud_prescriber_mo_1,
       CAST(1 + o.o_orderkey % 2 AS INT) AS pr_moud_prescriber_relat_1,
       CASE WHEN o.o_orderkey % 4 = 0 THEN 'p' || CAST(o.o_custkey % 40 AS STRING) ELSE '' END AS pr_moud_prescriber_2,
       CASE WHEN o.o_orderkey % 4 = 0 THEN '1' ELSE '' END AS pr_moud_prescriber_mo_2,
       CASE WHEN o.o_orderkey % 4 = 0 THEN 2 END AS pr_moud_prescriber_relat_2,
       CASE WHEN o.o_orderkey % 6 = 0 THEN '' ELSE CAST(o.o_custkey AS STRING) END AS pr_id,
       o.o_totalprice AS pr_amount
FROM {_JOINED}""",
    "v_baseline": f"""
SELECT s.program_id, s.type, CASE WHEN s.n_nationkey % 8 = 0 THEN NULL WHEN s.n_nationkey % 9 = 0 THEN 5 ELSE 1 END AS imp_support,
       {", ".join(
           f"CASE WHEN (s.n_nationkey + {k + j}) % 7 = 0 THEN 'na' ELSE CAST(sum(CASE WHEN month(o.o_orderdate) = {k + 1} AND (o.o_orderkey + s.n_nationkey) % {j + 2} = 0 THEN 1 ELSE 0 END) AS STRING) END AS demo_moud_{v}_{m}"
           for k, m in enumerate(BASE_MONTHS) for j, v in enumerate(BASE_VARS))}
FROM {_JOINED}
GROUP BY s.program_id, s.type, s.n_nationkey""",
    "v_patient_form": """
SELECT c_custkey AS pr_id, CAST(c_custkey % 2 AS INT) AS pr_new_admit, CAST(1 + c_custkey % 3 AS INT) AS form_complete,
       CAST(c_custkey % 2 AS INT) AS pr_gender___1, CAST(floor(c_custkey / 2.0) % 2 AS INT) AS pr_gender___2,
       CASE WHEN c_custkey % 7 > 0 THEN CAST(floor(c_custkey / 4.0) % 2 AS INT) END AS pr_race___1,
       CAST(floor(c_custkey / 8.0) % 2 AS INT) AS pr_race___2, CAST(floor(c_custkey / 16.0) % 2 AS INT) AS pr_race___3,
       CAST(c_custkey % 4 AS INT) AS pr_ethnicity
FROM {customer}""",
    "v_register": f"""
SELECT o.o_orderkey AS ID, s.program_id, CAST(o.o_orderdate AS DATE) AS admit_date,
       CAST(CAST(o.o_orderdate AS DATE) - CAST(o.o_orderkey % 5 AS INT) AS DATE) AS diag_date,
       CASE WHEN o.o_orderkey % 3 > 0 THEN CAST(CAST(o.o_orderdate AS DATE) + 90 AS DATE) END AS disc_date,
       CASE o.o_orderkey % 3 WHEN 0 THEN 'Naltrexone' ELSE 'Buprenorphine' END AS MOUD_type,
       'p' || CAST(o.o_orderkey % 40 AS STRING) AS init_prescriber,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 'Onsite' ELSE 'Offsite' END AS init_location,
       CAST(o.o_orderdate AS DATE) AS init_date, CAST(7 * (1 + o.o_orderkey % 4) AS INT) AS init_duration,
       'p' || CAST(o.o_custkey % 40 AS STRING) AS refill1_prescriber, 'Onsite' AS refill1_location,
       CAST(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 80 AS INT) AS DATE) AS refill1_date,
       CAST(14 + o.o_orderkey % 15 AS INT) AS refill1_duration,
       {", ".join(
           f"CASE WHEN o.o_orderkey % {n} > 0 THEN 'p' || CAST((o.o_custkey + {n}) % 40 AS STRING) END AS refill{n}_prescriber, "
           f"CASE WHEN o.o_orderkey % {n + 1} > 0 THEN 'Offsite' ELSE 'Onsite' END AS refill{n}_location, "
           f"CASE WHEN o.o_orderkey % {n + 2} > 0 THEN CAST(CAST(o.o_orderdate AS DATE) + {40 * n} + CAST(o.o_custkey % 60 AS INT) AS DATE) END AS refill{n}_date, "
           f"CAST({14 + n} + o.o_orderkey % 15 AS INT) AS refill{n}_duration" for n in range(2, 7))}
FROM {_JOINED}""",
}

def _needed(sql: str) -> list[str]:
    """Views a text uses, dependencies first."""
    out: list[str] = []

    def visit(text):
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in out:
                visit(VIEWS[name])
                out.append(name)

    visit(sql)
    return out


def with_views(sql: str) -> str:
    """A query text with the views it uses in front, for the SQL check."""
    parts = [f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in _needed(sql)]
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(parts)}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(parts)}, {body[5:]}"
    return f"WITH {', '.join(parts)} {body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame."""
    needed = _needed(name)
    text = " ".join(VIEWS[n] for n in needed)
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    parts = ", ".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    return spark.sql(f"WITH {parts} SELECT * FROM {name}", **used)
