"""Published instrument tables, codes and display names.

Everything here must equal the instruments' own values for results to be right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Scoring dictionary (question, item, subscale, reversed).
SURVEY_ITEMS = [
    ("01", "cdi_outer_1", "cdi_1eep", False),
    ("02", "cdi_outer_2", "cdi_1eep", False),
    ("03", "cdi_outer_3", "cdi_2cs", False),
    ("04", "cdi_outer_4", "cdi_2cs", False),
    ("05", "cdi_outer_5", "cdi_4he", False),
    ("06", "cdi_outer_6", "cdi_1eep", False),
    ("07", "cdi_outer_7", "cdi_1eep", False),
    ("08", "cdi_outer_8", "cdi_2cs", False),
    ("09", "cdi_outer_9", "cdi_5spm", False),
    ("10", "cdi_inner_1", "cdi_3ls", False),
    ("11", "cdi_inner_2", "cdi_3ls", False),
    ("12", "cdi_inner_3", "cdi_3ls", False),
    ("13", "cdi_inner_4", "cdi_3ls", False),
    ("14", "cdi_inner_5", "cdi_3ls", False),
    ("15", "cdi_inner_6", "cdi_6fea", False),
    ("16", "cdi_inner_7", "cdi_6fea", False),
    ("17", "cdi_inner_8", "cdi_7rtc", False),
    ("18", "cdi_inner_9", "cdi_4he", False),
    ("19", "cdi_inner_10", "cdi_6fea", False),
    ("20", "cdi_inner_11", "cdi_6fea", False),
    ("21", "cdi_inner_12", "cdi_6fea", True),
    ("22", "cdi_inner_13", "cdi_6fea", False),
    ("23", "cdi_inner_14", "cdi_4he", False),
    ("24", "cdi_inner_15", "cdi_6fea", True),
    ("25", "cdi_staff_1", "cdi_5spm", False),
    ("26", "cdi_staff_2", "cdi_5spm", False),
    ("27", "cdi_staff_3", "cdi_6fea", False),
    ("28", "cdi_staff_4", "cdi_6fea", False),
    ("29", "cdi_staff_5", "cdi_6fea", False),
    ("30", "cdi_staff_6", "cdi_7rtc", False),
    ("31", "cdi_staff_7", "cdi_7rtc", False),
    ("32", "cdi_staff_8", "cdi_8ic", False),
    ("33", "cdi_staff_9", "cdi_8ic", False),
    ("34", "cdi_staff_10", "cdi_8ic", False),
    ("35", "cdi_staff_11", "cdi_8ic", False),
    ("36", "cdi_staff_12", "cdi_4he", False),
    ("37", "cdi_patient_1", "cdi_4he", False),
    ("38", "cdi_patient_2", "cdi_5spm", False),
    ("39", "cdi_patient_3", "cdi_5spm", False),
    ("40", "cdi_patient_4", "cdi_5spm", True),
    ("41", "cdi_patient_5", "cdi_4he", False),
    ("42", "cdi_patient_6", "cdi_8ic", False),
]

# Codes and cut-offs.
DOES_NOT_APPLY = 8
LIKERT_MIDPOINT = 4
WITHDRAWN = 5
FORM_COMPLETE = 2
CATEGORIES = ["barriers", "neutral", "facilitators"]
TOTAL_SUBSCALE = "cdi_9total"
SITE_TYPES = ["SUD", "PC"]
NULL_TOKENS = ["", "NA", "na", "."]
GOAL_LABELS = {1: "Start MOUD", 2: "Expand MOUD"}
MIN_GAP_DAYS = 34
INJECTION_DAYS = 34
INJECTIONS = ["VIVITROL", "SUBLOCADE"]
FAST_ACCESS_DAYS = 3
STUDY_START = "2022-09-01"
RESTART_AFTER_DAYS_OFF = 28
COLLAPSED_SITES = [f"id{n}" for n in range(53, 63)]
FIVE_TO_SEVEN = {1: 1.0, 2: 2.5, 3: 4.0, 4: 5.5, 5: 7.0}
FACTOR_QUESTIONS = ["03", "04", "05", "06", "07", "08"]
FACTOR_ITEM = "imat_d5_6"
FACTOR_EXCLUDED_SITES = [f"id{n}" for n in range(54, 63)]
LOW_BARRIER_ITEMS = [
    "imat_d3_11", "imat_d3_12", "imat_d3_14", "imat_d4_9", "imat_d5_5",
    "imat_d5_6", "imat_d6_1", "imat_d6_2", "imat_d7_3",
]
INTERVIEW_VARIABLES = ["imat_total", "imat_d5", "imat_d6", "reaim_b4p", "reaim_a1", "reaim_b1"]
REFERRAL_VARIABLES = ["reaim_c6", "reaim_c7", "reaim_c8"]
REPORT_DATES = ["Sep-22", "Apr-23"]
REBASED_MONTHS = ["Sep-22", "Oct-22", "Nov-22"]
KEPT_MONTHS = ["Dec-22", "Jan-23", "Feb-23"]
TARGET_PERCENT = 75
MANUAL_DATE_FORMATS = ["MMM-yy", "MMM-yyyy", "MMM yy", "MMM yyyy"]

# Display names, spelled as published.
DISPLAY_NAMES = [
    ("cdi_1eep", "Enabiling External Policies"),
    ("cdi_2cs", "Community Support"),
    ("cdi_3ls", "Leadership Support"),
    ("cdi_4he", "Health Equity"),
    ("cdi_5spm", "Staff Perception of MOUD"),
    ("cdi_6fea", "Feasibility"),
    ("cdi_7rtc", "Readiness to Change"),
    ("cdi_8ic", "Individualized Care"),
    ("outer", "System Level"),
    ("inner", "Clinic/Program Level"),
    ("staff", "Staff Level"),
    ("patient", "Patient Level"),
    ("total", "Total"),
]
DIMENSION_NAMES = [
    ("imat_d1", "Infrastructure"),
    ("imat_d2", "Culture &\nEnvironment"),
    ("imat_d3", "Patient Identification\n& Initiating Care"),
    ("imat_d4", "Care Delivery & Treatment\nResponse Monitoring"),
    ("imat_d5", "Care Coordination"),
    ("imat_d6", "Workforce"),
    ("imat_d7", "Staff Training\n& Development"),
    ("imat_total", "Total"),
]
REFERRAL_NAMES = [
    ("reaim_c6", "Referred and linkage confirmed"),
    ("reaim_c7", "Referred but did not confirm linkage"),
    ("reaim_c8", "No referral"),
]

# Headers of the visit and prescription extracts.
VISIT_HEADERS = {
    "cln enc date": "encounter_date",
    "prvdr": "provider",
    "svc dprtmnt": "site_name",
}
PRESCRIPTION_HEADERS = {
    "order chartdate": "rx_order_date",
    "order name (single)": "rx_name",
    "quantity prescribed": "rx_quantity",
    "no. of refills": "rx_num_refills",
    "ordr provdr fll nm": "rx_provider",
    "order dprtmnt": "rx_site_name",
    "cd-10 clncl rdr dgnss cd": "rx_icd10_dx",
    "homelessstatus": "patient_isHomeless",
    "patientsex": "patient_sex",
    "pat gender": "patient_gender",
    "pat gender identity": "patient_gender_identity",
    "ethnicity": "patient_ethnicity",
    "race": "patient_race",
    "patient lang": "patient_language",
    "pat sex orientation": "patient_sexual_orientation",
}


def scoring_dictionary(spark: SparkSession) -> DataFrame:
    """The 42-row scoring dictionary."""
    return spark.createDataFrame(
        SURVEY_ITEMS, "q_num string, item string, subscale string, isReverse boolean"
    )


def name_table(spark: SparkSession, pairs, code: str, label: str) -> DataFrame:
    """A literal code-to-label table (bounded by the code that lists it)."""
    return spark.createDataFrame(pairs, f"`{code}` string, `{label}` string")
