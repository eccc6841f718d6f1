"""Registry exports: cleanup, provider months, patient rows, demographics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.functions.dates import month_back, month_from_event
from carelens.functions.nulls import blank_to_null
from carelens.operators.ordered import Hot
from carelens.operators.reshape import explode_list, find_blocks, melt_blocks, unite_onehot
from carelens.operators.select import across, drop_withdrawn, keep_complete, pick_columns
from carelens.operators.windows import locf

PROVIDER = "pr_moud_prescriber"


def registry_cleanup(export: DataFrame, order: list[str], hot: Hot | None = None) -> DataFrame:
    """Status carried down by site, withdrawn sites and incomplete forms dropped, blanks to null."""
    filled = locf(export, ["program_id"], order, "imp_support", hot=hot)
    kept = keep_complete(drop_withdrawn(filled), "form_complete")
    kept = kept.withColumn("survey_month", month_from_event(F.col("event_name")))
    texts = [f.name for f in kept.schema.fields if isinstance(f.dataType, T.StringType)]
    return across(kept, texts, blank_to_null)


def provider_rows(registry: DataFrame) -> DataFrame:
    """One row per prescriber and month."""
    blocks = find_blocks(registry.select(*pick_columns(registry, prefix=PROVIDER)), r"pr_moud_([a-z_]+)_(\d+)")
    long = melt_blocks(registry, ["program_id", "survey_month"], blocks, "block")
    named = long.filter(F.col("prescriber").isNotNull())
    monthly = explode_list(named, "prescriber_mo", ",", "int")
    return monthly.select(
        "program_id",
        month_back(F.col("survey_month"), F.col("prescriber_mo")).alias("month"),
        "prescriber",
        "prescriber_relat",
    )


def provider_months(registry: DataFrame) -> DataFrame:
    """Prescriber rows by site and month: all of them (A1), those not employed by the site (A2)."""
    counts = provider_rows(registry).groupBy("program_id", "month").agg(
        F.count(F.lit(1)).alias("A1"), F.count_if(F.col("prescriber_relat") == 2).alias("A2")
    )
    # a site-month without outside prescribers has no A2 value
    return counts.withColumn("A2", F.when(F.col("A2") > 0, F.col("A2")))


def patient_rows(registry: DataFrame) -> DataFrame:
    """Rows holding a patient report, without provider columns."""
    return registry.drop(*pick_columns(registry, prefix=PROVIDER)).filter(F.col("pr_id").isNotNull())


def demographics(forms: DataFrame) -> DataFrame:
    """New admissions with ticked gender and race codes united."""
    new = keep_complete(forms, "form_complete").filter(F.col("pr_new_admit") == 1)
    kept = [c for p in ("pr_gender", "pr_race", "pr_ethnicity") for c in pick_columns(new, prefix=p)]
    out = new.select("pr_id", *kept)
    return unite_onehot(unite_onehot(out, "pr_gender___", "pr_gender"), "pr_race___", "pr_race")
