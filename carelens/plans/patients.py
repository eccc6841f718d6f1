"""Visit and prescription extracts to corrected ids, flags, cohort and treatment months.

Everything up to the episodes is keyed by patient: one hash partitioning by
patient serves ids, flags, episodes and the as-of match.  Sites enter only in
the id numbering and in the final counts.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.dates import month_start
from carelens.functions.text import contains_any, parse_number
from carelens.operators.joins import asof_forward, asof_hot_input, overlap_months, restrict_to_cohort
from carelens.operators.ordered import Hot, cut_heavy, draw, find_hot
from carelens.operators.select import left_lookup, same_keys
from carelens.operators.windows import (
    assign_ids,
    episodes,
    first_per_key,
    flag_breaks,
    flag_first,
    flag_restarts,
    flag_starts,
)
from carelens.sources.staging import stage

PATIENT = "id_from_site"
RX_ORDER = ["rx_order_date", "rx_id"]
VISIT_ORDER = ["encounter_date", "visit_id"]


@dataclass(frozen=True)
class Balance:
    """Heavy keys of the extracts; None entries mean plain windows."""

    site: Hot | None = None
    rx: Hot | None = None
    visit: Hot | None = None
    match: Hot | None = None


def measure_balance(visits: DataFrame, rx: DataFrame, decoder: DataFrame) -> Balance:
    """Look for heavy sites and patients in the raw extracts, from one bounded sample of each."""
    sited = left_lookup(visits, decoder, [("site_name", "site_name")]).select(PATIENT, *VISIT_ORDER, "program_id")
    narrow = rx.select(PATIENT, *RX_ORDER)
    rows = max(sited.count(), narrow.count())
    some_visits, some_rx = draw(sited, rows), draw(narrow, rows)
    events = asof_hot_input(visits, rx, [PATIENT], "encounter_date", "rx_order_date", "visit_id")
    mixed = [Row(**{PATIENT: r[PATIENT], "_date": r["encounter_date"], "_side": 0, "_id": r["visit_id"]}) for r in some_visits]
    mixed += [Row(**{PATIENT: r[PATIENT], "_date": r["rx_order_date"], "_side": 1, "_id": None}) for r in some_rx]
    return Balance(
        site=cut_heavy(sited, ["program_id"], ["encounter_date", PATIENT], some_visits),
        rx=cut_heavy(narrow, [PATIENT], RX_ORDER, some_rx),
        visit=cut_heavy(sited, [PATIENT], VISIT_ORDER, some_visits),
        match=cut_heavy(events, [PATIENT], ["_date", "_side", "_id"], mixed),
    )


def patient_ids(visits: DataFrame, decoder: DataFrame, balance: Balance = Balance()) -> DataFrame:
    """Old id to corrected id, from the first visit and its site."""
    first = first_per_key(visits.select(PATIENT, "encounter_date", "visit_id", "site_name"), PATIENT, VISIT_ORDER)
    sited = left_lookup(first, decoder.select("site_name", "program_id"), [("site_name", "site_name")])
    if balance.site is not None:
        sited = stage(sited, "first_visits")  # cutting by site reads its input twice
        # patients start early: first visits lie otherwise than all visits, so they are cut by bounds of their own
        balance = replace(balance, site=find_hot(sited, ["program_id"], ["encounter_date", PATIENT]))
    return assign_ids(sited, PATIENT, "program_id", "encounter_date", "pr_id", balance.site).select(PATIENT, "pr_id")


def _with_ids(events: DataFrame, ids: DataFrame, date: str) -> DataFrame:
    joined = same_keys(events.drop("program_id"), ids, [PATIENT])
    return joined.withColumns(
        {
            "program_id": F.concat(F.lit("id"), F.substring("pr_id", 1, 2)),
            "month": month_start(F.col(date)),
        }
    )


def _flag_rx(rx: DataFrame, hot: Hot | None) -> DataFrame:
    flagged = flag_restarts(rx, [PATIENT], RX_ORDER, "rx_order_date", "est_rx_days", "rx_num_refills", hot=hot)
    return flag_breaks(flagged, [PATIENT], RX_ORDER, hot=hot)


def prescription_flags(rx: DataFrame, ids: DataFrame, balance: Balance = Balance()) -> DataFrame:
    """Site, month, supply days, restart and break flags.

    Patients without any visit have no corrected id; each keeps a history of
    its own, and none of them can enter the study.
    """
    days = F.when(contains_any(F.col("rx_name"), fixed.INJECTIONS), float(fixed.INJECTION_DAYS)).otherwise(
        parse_number(F.col("rx_quantity"))
    )
    return _flag_rx(_with_ids(rx, ids, "rx_order_date").withColumn("est_rx_days", days), balance.rx)


def visit_flags(visits: DataFrame, ids: DataFrame, rx_flags: DataFrame, balance: Balance = Balance()) -> DataFrame:
    """Site, month, first-visit flag, and restart when a restart prescription has the same date."""
    own = flag_first(_with_ids(visits, ids, "encounter_date"), [PATIENT], VISIT_ORDER, hot=balance.visit)
    restarts = rx_flags.filter("is_restart").select(
        PATIENT, F.col("rx_order_date").alias("encounter_date"), F.lit(True).alias("is_restart")
    ).distinct()
    return same_keys(own, restarts, [PATIENT, "encounter_date"]).fillna({"is_restart": False})


def study_cohort(visits: DataFrame, start: str = fixed.STUDY_START) -> DataFrame:
    """Patients with a start or restart on or after a date, and the first such date."""
    eligible = visits.filter(F.col("is_start") | F.col("is_restart")).filter(
        F.col("encounter_date") >= F.lit(start).cast("date")
    )
    return eligible.groupBy(PATIENT).agg(F.min("encounter_date").alias("first_study_date"))


def study_prescriptions(rx: DataFrame, cohort: DataFrame, balance: Balance = Balance()) -> DataFrame:
    """Prescriptions of the cohort from entry on, flags computed anew."""
    mine = restrict_to_cohort(rx.drop("is_restart", "is_break"), cohort, PATIENT, "rx_order_date", "first_study_date")
    return _flag_rx(mine, balance.rx)


def study_visits(visits: DataFrame, cohort: DataFrame, balance: Balance = Balance()) -> DataFrame:
    """Visits of the cohort from entry on; the first is the start and no restart."""
    mine = restrict_to_cohort(visits.drop("is_start"), cohort, PATIENT, "encounter_date", "first_study_date")
    return flag_starts(mine, [PATIENT], VISIT_ORDER, hot=balance.visit)


def treatment_episodes(study_rx: DataFrame, balance: Balance = Balance()) -> DataFrame:
    return episodes(
        study_rx, [PATIENT, "pr_id", "program_id"], RX_ORDER, "rx_order_date", "est_rx_days", balance.rx
    )


def treatment_months(study_rx: DataFrame, balance: Balance = Balance()) -> DataFrame:
    """Episodes by month on treatment, among the months the study prescriptions show."""
    return overlap_months(treatment_episodes(study_rx, balance), "start_date", "end_date", study_rx, "month")


def match_visits(visits: DataFrame, rx: DataFrame, balance: Balance = Balance()) -> DataFrame:
    """Nearest prescription on or after each visit."""
    return asof_forward(
        visits, rx, [PATIENT], "encounter_date", "rx_order_date", "visit_id", "nearest_rx", balance.match
    )
