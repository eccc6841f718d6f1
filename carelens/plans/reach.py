"""Monthly measures by site: prescribers, patients, new patients, on treatment, fast access."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens import fixed
from carelens.functions.dates import days_between
from carelens.functions.nulls import n_unique, percent
from carelens.operators.reshape import densify, pivot
from carelens.operators.select import left_lookup, small_side, stack
from carelens.plans import patients as P
from carelens.sources.staging import cut_lineage, stage

MEASURES = ["reaim_a1", "reaim_b1", "reaim_b2", "reaim_b4", "reaim_b4p", "reaim_c1_n", "reaim_c1p"]


@dataclass(frozen=True)
class Study:
    """Study prescriptions, visits and treatment months, and what balances their windows."""

    rx: DataFrame
    visits: DataFrame
    months: DataFrame
    decoder: DataFrame
    balance: P.Balance


def build_study(visits, rx, decoder, start: str = fixed.STUDY_START, keep: bool = True) -> Study:
    """Run the patient steps.  ``keep`` writes the tables that several later steps read."""
    decoder = small_side(decoder)
    balance = P.measure_balance(visits, rx, decoder)
    ids = P.patient_ids(visits, decoder, balance)
    if keep:
        ids = stage(ids, "patient_ids")
    rx_flags = P.prescription_flags(rx, ids, balance)
    v_flags = P.visit_flags(visits, ids, rx_flags, balance)
    if keep:
        rx_flags, v_flags = stage(rx_flags, "rx_flags"), stage(v_flags, "visit_flags")
    cohort = P.study_cohort(v_flags, start)
    s_rx = P.study_prescriptions(rx_flags, cohort, balance)
    s_visits = P.study_visits(v_flags, cohort, balance)
    if keep:
        s_rx, s_visits = stage(s_rx, "study_rx"), stage(s_visits, "study_visits")
    return Study(s_rx, s_visits, P.treatment_months(s_rx, balance), decoder, balance)


def _long(counts: DataFrame, names: dict[str, str]) -> DataFrame:
    """Count columns to long rows; a site and month without a count has no row."""
    cols = {new: F.col(old).cast("double") for old, new in names.items()}
    wide = counts.select("program_id", F.col("month").alias("date"), *[c.alias(n) for n, c in cols.items()])
    return wide.unpivot(["program_id", "date"], list(cols), "variable", "value").filter(
        F.col("value").isNotNull()
    )


def _filled(long: DataFrame) -> DataFrame:
    """Zero fill by measure.  The counts are a small table by now and kept before the grid reads them."""
    marked = long.withColumn("family", F.substring("variable", 1, 8))
    out = densify(cut_lineage(marked), ["program_id", "variable", "family"], "date", "value", 0.0, within=["family"])
    return out.drop("family")


def shared_site_ids(decoder: DataFrame) -> DataFrame:
    """Site ids that several site names decode to."""
    return decoder.groupBy("program_id").agg(F.count_distinct("site_name").alias("names")).filter("names > 1")


def _a1(study: Study) -> DataFrame:
    sited = left_lookup(
        study.rx.drop("program_id"), study.decoder.select("site_name", "program_id"), [("rx_site_name", "site_name")]
    )
    counts = sited.groupBy("program_id", "month").agg(n_unique(F.col("rx_provider")).alias("a1"))
    return _long(counts, {"a1": "reaim_a1"})


def _seen(study: Study) -> DataFrame:
    """Per site and month: patients seen (b1) and, of these, on treatment (b4).

    A patient counts in the month of the first visit and in months on
    treatment; one reduction by patient and month serves both measures.
    """
    cols = [P.PATIENT, "program_id", "month"]
    first = study.visits.filter("is_start").select(*cols, F.lit(0).alias("on"))
    treated = study.months.select(*cols, F.lit(1).alias("on"))
    per_patient = stack(first, treated).groupBy(*cols).agg(F.max("on").alias("on"))
    return per_patient.groupBy("program_id", "month").agg(
        F.count(F.lit(1)).alias("b1"), F.nullif(F.sum("on"), F.lit(0)).alias("b4")
    )


def _new(study: Study, days: int | None) -> DataFrame:
    """Per site and month: patients with a start or restart visit (b2) and their visits with a
    prescription within ``days`` (c1).  c1 counts visits, so it can exceed b2."""
    visits = study.visits.filter("is_start or is_restart")
    quick = F.lit(0)
    if days is not None:
        visits = P.match_visits(visits, study.rx, study.balance)
        quick = F.coalesce((days_between(F.col("nearest_rx"), F.col("encounter_date")) <= days).cast("int"), F.lit(0))
    per_patient = visits.groupBy(P.PATIENT, "program_id", "month").agg(F.sum(quick).alias("quick"))
    return per_patient.groupBy("program_id", "month").agg(
        F.count(F.lit(1)).alias("b2"), F.nullif(F.sum("quick"), F.lit(0)).alias("c1")
    )


def _with_percent(counts: DataFrame, n: str, base: str, names: tuple[str, str]) -> DataFrame:
    """A count and its percent of a base; a month with a count always has a base."""
    pct = counts.withColumn("_pct", percent(F.col(n), F.col(base)))
    return _long(pct, {n: names[0], "_pct": names[1]})


def a1_prescribers(study: Study) -> DataFrame:
    """Distinct prescribers by site of prescription and month."""
    return _filled(_a1(study))


def b1_patients(study: Study) -> DataFrame:
    """Distinct patients by site and month: first visit month and months on treatment."""
    return _filled(_long(_seen(study), {"b1": "reaim_b1"}))


def b2_new_patients(study: Study) -> DataFrame:
    """Distinct patients with a start or restart visit."""
    return _filled(_long(_new(study, None), {"b2": "reaim_b2"}))


def b4_on_treatment(study: Study) -> DataFrame:
    """Distinct patients on treatment, and their percent of b1."""
    return _filled(_with_percent(_seen(study), "b4", "b1", ("reaim_b4", "reaim_b4p")))


def c1_fast_access(study: Study, days: int = fixed.FAST_ACCESS_DAYS, names=("reaim_c1_n", "reaim_c1p")) -> DataFrame:
    """Start and restart visits with a prescription within ``days``, and their percent of b2."""
    return _filled(_with_percent(_new(study, days), "c1", "b2", names))


def measures_long(study: Study) -> DataFrame:
    """All measures: three reductions to site and month, one zero fill."""
    seen = _seen(study).withColumn("_b4p", percent(F.col("b4"), F.col("b1")))
    new = _new(study, fixed.FAST_ACCESS_DAYS).withColumn("_c1p", percent(F.col("c1"), F.col("b2")))
    return _filled(
        stack(
            _a1(study),
            _long(seen, {"b1": "reaim_b1", "b4": "reaim_b4", "_b4p": "reaim_b4p"}),
            _long(new, {"b2": "reaim_b2", "c1": "reaim_c1_n", "_c1p": "reaim_c1p"}),
        )
    )


def measures_wide(study: Study) -> DataFrame:
    """All measures, one row per site and month."""
    return pivot(measures_long(study), ["program_id", "date"], "variable", "value", MEASURES)
