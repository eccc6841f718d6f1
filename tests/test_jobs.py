"""Jobs and operators on small hand-written frames."""

import datetime

import pytest
from pyspark.sql import functions as F

from carelens import fixed
from carelens.operators import aggs as A
from carelens.operators import reshape as R
from carelens.operators import select as S
from carelens.operators import windows as W
from carelens.operators.joins import replace_by_key
from carelens.plans import baseline, combine, patients, reach, registry, reports, summaries, survey, tables

D = datetime.date


def test_withdrawn_and_missing_status_are_dropped(spark, rows):
    df = spark.createDataFrame([("a", None), ("b", 1), ("c", 5)], "program_id string, imp_support int")
    assert rows(S.drop_withdrawn(df)) == [("b", 1)]


def exports(spark):
    return spark.createDataFrame(
        [
            (D(2022, 9, 1), "id01", "SUD", 1, 1, 1, 8),
            (D(2022, 9, 1), "id01", "SUD", 1, 7, 4, None),
            (D(2022, 9, 1), "id02", "SUD", 1, 4, None, None),
            (D(2022, 9, 1), "id60", "PC", 5, 7, 7, 7),
            (D(2022, 9, 1), "id61", "PC", None, 7, 7, 7),
        ],
        "date date, program_id string, type string, imp_support int, cdi_outer_1 int, cdi_inner_12 int, cdi_patient_6 int",
    )


def test_scoring(spark, rows):
    want = [
        ("id01", "cdi_1eep", 1, 0, 1), ("id01", "cdi_6fea", 0, 1, 1), ("id01", "cdi_8ic", 0, 1, 0),
        ("id01", "cdi_9total", 1, 2, 2), ("id02", "cdi_1eep", 0, 1, 0), ("id02", "cdi_9total", 0, 1, 0),
    ]
    cols = ["program_id", "subscale", "barriers", "neutral", "facilitators"]
    assert rows(survey.survey_scoring(exports(spark)), *cols) == want
    keys = ["date", "program_id", "type"]
    scored = survey.score_answers(S.drop_withdrawn(exports(spark)), keys)
    assert rows(survey.count_answers(scored, keys), *cols) == want  # the long way round gives the same


def test_two_scores(spark):
    scored = survey.score_answers(exports(spark).limit(1), ["program_id"])
    got = {r["item"]: (r["raw_value"], r["scaled_value"], r["oriented_value"], r["cat"]) for r in scored.collect()}
    assert got == {
        "cdi_outer_1": (1, -3, 1, "barriers"),
        "cdi_inner_12": (1, 3, 7, "facilitators"),  # a reversed item
        "cdi_patient_6": (None, 0, None, "neutral"),  # does not apply: neutral, yet in no mean
    }


@pytest.mark.parametrize("dna,cutoff", [(0, 0), (0, 1), (None, 0), (2, 1)])
def test_wide_and_long_counts_agree(spark, rows, dna, cutoff):
    data = [(f"id{i % 3}", 1 + i % 8, None if i % 5 == 0 else 1 + (i * 3) % 8, 1 + (i * 5) % 8) for i in range(80)]
    df = spark.createDataFrame(data, "program_id string, cdi_outer_1 int, cdi_inner_12 int, cdi_staff_9 int")
    long = survey.count_answers(survey.score_answers(df, ["program_id"], dna, cutoff), ["program_id"])
    wide = survey.count_wide_answers(df, ["program_id"], dna, cutoff)
    assert rows(wide.select(long.columns)) == rows(long)


def likert(spark, sites):
    """One answer per (site, type, item, value)."""
    rows = [(s, t, i, v) for s, t, answers in sites for i, v in answers]
    long = spark.createDataFrame(rows, "program_id string, type string, item string, value int")
    wide = long.withColumn("n", F.monotonically_increasing_id()).groupBy("n", "program_id", "type").pivot("item").max("value")
    return survey.score_answers(wide.drop("n"), ["program_id", "type"])


def test_all_neutral_cells_leave_the_tables(spark):
    """A site with neutral answers only drops out of its cell, which moves the totals."""
    scored = likert(spark, [
        ("id01", "SUD", [("cdi_outer_1", 1), ("cdi_staff_1", 7)]),
        ("id02", "SUD", [("cdi_outer_1", 4), ("cdi_staff_1", 1)]),
        ("id60", "PC", [("cdi_outer_1", 7), ("cdi_staff_1", 7)]),
    ])
    level = {r["fmt_name"]: r for r in tables.level_table(scored).collect()}
    assert level["System Level"]["SUD_barriers_percent"] == 1.0  # id02 is left out, not counted as 0
    assert level["Total"]["SUD_barriers_percent"] == pytest.approx((1 + 0 + 1) / 3)
    assert level["Total"]["all_barriers_percent"] == pytest.approx(2 / 5)
    assert level["Total"]["SUD_mean_v"] == pytest.approx((1 + 7 + 4 + 1) / 4)
    subscale = {r["fmt_name"]: r for r in tables.subscale_table(scored).collect()}
    drop = ("position", "fmt_name")
    assert {k: v for k, v in subscale["Total"].asDict().items() if k not in drop} == {
        k: v for k, v in level["Total"].asDict().items() if k not in drop
    }


def test_counted_answers_give_the_same_tables(spark, rows):
    data = [(f"id{i % 4}", "SUD" if i % 4 < 2 else "PC", 1 + i % 8, None if i % 5 == 0 else 1 + (i * 3) % 8) for i in range(60)]
    wide = spark.createDataFrame(data, "program_id string, type string, cdi_outer_1 int, cdi_inner_12 int")
    one, many = (survey.score_answers(wide, ["program_id", "type"], counted=c) for c in (False, True))
    assert many.count() < one.count() == many.agg(F.sum("answers")).first()[0]

    def near(df):  # the order of a sum shows in the last bit
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df)]

    for table in (tables.level_table, tables.subscale_table, tables.question_table):
        assert near(table(one)) == near(table(many))
    for job in (summaries.site_distribution, summaries.question_summary):
        assert near(job(survey.with_site_group(one))) == near(job(survey.with_site_group(many)))


def test_published_totals_follow_from_the_level_cells():
    """Totals are unweighted means of site by level cells: 13 SUD sites, one missing at one level."""
    sud = [17.44, 19.44, 3.85, 1.92]
    assert sum(n * v for n, v in zip([13, 12, 13, 13], sud)) / 51 == pytest.approx(10.49, abs=0.01)
    assert sum(sud) / 4 == pytest.approx(10.66, abs=0.01)
    pc = (7.22 + 9.26 + 2.78 + 6.94) / 4
    assert pc == pytest.approx(6.55, abs=0.01)
    assert (51 * 10.49 + 48 * 6.55) / 99 == pytest.approx(8.58, abs=0.01)


def test_share_table_reproduces_that_rule(spark):
    """The same shape of data gives the published totals through `share_means`."""
    cells = []
    for level, n, v in [("inner", 13, 17.44), ("outer", 12, 19.44), ("patient", 13, 3.85), ("staff", 13, 1.92)]:
        cells += [(f"id{i:02d}", "SUD", level, v, 0.0) for i in range(n)]
    for level, v in [("inner", 7.22), ("outer", 9.26), ("patient", 2.78), ("staff", 6.94)]:
        cells += [(f"id{50 + i}", "PC", level, v, 0.0) for i in range(12)]
    df = spark.createDataFrame(cells, "program_id string, type string, level string, barriers_percent double, facilitators_percent double")
    r = tables.share_means(df, []).first()
    assert (round(r["SUD_barriers_percent"], 2), round(r["PC_barriers_percent"], 2), round(r["all_barriers_percent"], 2)) == (10.49, 6.55, 8.58)


def rx(spark, data):
    return spark.createDataFrame(
        [(i, p, day, name, q, refills, "dr", "S") for i, (p, day, name, q, refills) in enumerate(data)],
        "rx_id int, id_from_site int, rx_order_date date, rx_name string, rx_quantity string, rx_num_refills int, rx_provider string, rx_site_name string",
    )


def test_restart_rule(spark):
    start = D(2022, 1, 1)

    def after(*gaps):
        days, out = 0, []
        for g in gaps:
            days += g
            out.append(start + datetime.timedelta(days=days))
        return out

    d = after(0, 33, 34, 60, 60, 34, 34, 50)
    data = [
        (1, d[0], "B", "30 tabs", 0),  # first: no restart
        (1, d[1], "B", "30 tabs", 0),  # 33 days: too short a gap
        (1, d[2], "B", "30 tabs", 1),  # 34 days, 30 supplied: restart
        (1, d[3], "B", "1,000 tabs", 0),  # 60 days, 30 * 2 supplied: restart, the gap must be shorter
        (1, d[4], "VIVITROL", "1", 0),  # 60 days, 1000 supplied: covered
        (1, d[5], "B", "30 tabs", None),  # 34 days after an injection of 34: restart
        (1, d[6], "B", "30 tabs", 0),  # refills before unknown: restart
        (1, d[7], "B", "?", 0),
        (2, d[0], "B", "30 tabs", 0),  # a single row is start and break at once
    ]
    ids = spark.createDataFrame([(1, "01-0001"), (2, "01-0002")], "id_from_site int, pr_id string")
    got = {r["rx_id"]: (r["is_restart"], r["is_break"]) for r in patients.prescription_flags(rx(spark, data), ids).collect()}
    assert [got[i][0] for i in range(9)] == [False, False, True, True, False, True, True, True, False]
    assert [got[i][1] for i in range(9)] == [False, True, True, False, True, True, True, True, True]


def test_episode_end_uses_last_supply_without_refills(spark):
    data = [(1, D(2022, 1, 1), "B", "30 tabs", 5), (1, D(2022, 1, 20), "B", "10 tabs", 5)]
    ids = spark.createDataFrame([(1, "01-0001")], "id_from_site int, pr_id string")
    flags = patients.prescription_flags(rx(spark, data), ids)
    span = patients.treatment_episodes(flags).first()
    assert (span["start_date"], span["end_date"], span["program_id"]) == (D(2022, 1, 1), D(2022, 1, 30), "id01")


def test_ids_grow_past_four_digits(spark):
    n = 10_050
    df = spark.range(1, n + 1).select("id", F.lit("id07").alias("site"), F.lit(D(2022, 1, 1)).alias("day"))
    last = W.assign_ids(df, "id", "site", "day", "pr_id").filter(F.col("id").isin(1, n)).orderBy("id").collect()
    assert [r["pr_id"] for r in last] == ["07-0001", "07-10050"]


def tiny_study(spark, start="2022-09-01"):
    visits = spark.createDataFrame(
        [
            (0, 1, D(2022, 8, 1), "S"),  # before the study
            (1, 1, D(2022, 12, 20), "S"),  # restart prescription on this date: entry
            (2, 2, D(2022, 9, 5), "S"), (3, 2, D(2022, 9, 5), "S"),  # same day twice: one patient, one start visit
            (4, 3, D(2022, 10, 1), "T"),  # no prescription ever
            (5, 4, D(2022, 7, 1), "T"),  # never enters
        ],
        "visit_id int, id_from_site int, encounter_date date, site_name string",
    )
    prescriptions = spark.createDataFrame(
        [
            (0, 1, D(2022, 8, 2), "B", "30", 0, "a", "S"), (1, 1, D(2022, 12, 20), "B", "30", 0, None, "S"),
            (2, 2, D(2022, 9, 9), "B", "40", 0, "a", "S"), (3, 2, D(2022, 9, 8), "B", "20", 0, "b", "S"),
            (4, 9, D(2022, 9, 8), "B", "20", 0, "b", "S"),  # a patient without visits
        ],
        "rx_id int, id_from_site int, rx_order_date date, rx_name string, rx_quantity string, rx_num_refills int, rx_provider string, rx_site_name string",
    )
    decoder = spark.createDataFrame([("S", "id10"), ("T", "id60")], "site_name string, program_id string")
    return reach.build_study(visits, prescriptions, decoder, start)


def test_study_and_measures(spark, rows):
    study = tiny_study(spark)
    assert rows(study.visits, "visit_id", "pr_id", "is_start", "is_restart") == [
        (1, "10-0001", True, False), (2, "10-0002", True, False), (3, "10-0002", False, False), (4, "60-0002", True, False),
    ]
    assert rows(study.rx, "rx_id", "is_restart", "is_break") == [(1, False, True), (2, False, True), (3, False, False)]
    got = {(r[0], r[1], r[2].month): r[3] for r in reach.measures_long(study).select("program_id", "variable", "date", "value").collect()}
    assert got[("id10", "reaim_a1", 9)] == 2 and got[("id10", "reaim_a1", 12)] == 1  # a missing name counts once
    assert got[("id10", "reaim_b1", 9)] == 1 and got[("id60", "reaim_b1", 10)] == 1
    assert got[("id60", "reaim_b1", 9)] == 0  # zero fill over the months of the measure
    assert got[("id10", "reaim_b4", 12)] == 1 and got[("id10", "reaim_b4p", 12)] == 100
    # months on treatment are taken from months with study prescriptions only: Oct and Jan are not among them
    assert ("id10", "reaim_b4", 10) not in got
    assert got[("id10", "reaim_c1_n", 9)] == 1 and got[("id10", "reaim_c1p", 9)] == 100  # 3 days count
    assert ("id60", "reaim_c1_n", 10) not in got
    wide = rows(reach.measures_wide(study), "program_id", "date", "reaim_b2", "reaim_c1_n")
    assert ("id60", D(2022, 10, 1), 1.0, None) in wide


def test_patients_of_an_undecoded_site_stay_apart(spark):
    """Three patients at a site the decoder lacks are three, and their rows keep their values."""
    visits = spark.createDataFrame([(i, i, D(2022, 9, 1 + i), "?") for i in (1, 2, 3)], "visit_id int, id_from_site int, encounter_date date, site_name string")
    rx = spark.createDataFrame(
        [(i, i, D(2022, 9, 1 + i), "B", "30", 0, "a", "?") for i in (1, 2, 3)],
        "rx_id int, id_from_site int, rx_order_date date, rx_name string, rx_quantity string, rx_num_refills int, rx_provider string, rx_site_name string",
    )
    decoder = spark.createDataFrame([("S", "id10")], "site_name string, program_id string")
    study = reach.build_study(visits, rx, decoder, "2022-09-01")
    got = {(r["program_id"], r["variable"]): r["value"] for r in reach.measures_long(study).collect()}
    assert got == {(None, "reaim_a1"): 1, (None, "reaim_b1"): 3, (None, "reaim_b2"): 3, (None, "reaim_b4"): 3, (None, "reaim_b4p"): 100, (None, "reaim_c1_n"): 3, (None, "reaim_c1p"): 100}


def test_events_without_patient_id_are_one_patient(spark):
    visits = spark.createDataFrame([(1, 1, D(2022, 9, 2), "S"), (2, None, D(2022, 9, 3), "S"), (3, None, D(2022, 9, 4), "S")], "visit_id int, id_from_site int, encounter_date date, site_name string")
    rx = spark.createDataFrame(
        [(1, 1, D(2022, 9, 2), "B", "30", 0, "a", "S"), (2, None, D(2022, 9, 4), "B", "30", 0, "b", "S")],
        "rx_id int, id_from_site int, rx_order_date date, rx_name string, rx_quantity string, rx_num_refills int, rx_provider string, rx_site_name string",
    )
    decoder = spark.createDataFrame([("S", "id10")], "site_name string, program_id string")
    study = reach.build_study(visits, rx, decoder, "2022-09-01")
    got = {r["variable"]: r["value"] for r in reach.measures_long(study).collect()}
    assert got["reaim_b1"] == 2 and got["reaim_a1"] == 2 and got["reaim_b4"] == 2


def test_bad_quantities(spark):
    """Unreadable and oversized quantities end no job: the episode has no end and touches no month; a long one touches the observed months."""
    quantities = ["9999999999 tabs", "as directed", "900000 tabs", "30 tabs"]
    visits = spark.createDataFrame([(i, i, D(2022, 9, 1), "S") for i in range(4)], "visit_id int, id_from_site int, encounter_date date, site_name string")
    rx = spark.createDataFrame(
        [(i, i, D(2022, 9, 1), "B", q, 0, "a", "S") for i, q in enumerate(quantities)] + [(9, 3, D(2023, 5, 1), "B", "30", 0, "a", "S")],
        "rx_id int, id_from_site int, rx_order_date date, rx_name string, rx_quantity string, rx_num_refills int, rx_provider string, rx_site_name string",
    )
    decoder = spark.createDataFrame([("S", "id10")], "site_name string, program_id string")
    study = reach.build_study(visits, rx, decoder, "2022-09-01")
    months = sorted((r["id_from_site"], r["month"]) for r in study.months.select("id_from_site", "month").collect())
    assert months == [(2, D(2022, 9, 1)), (2, D(2023, 5, 1)), (3, D(2022, 9, 1)), (3, D(2023, 5, 1))]


def test_longer_window_counts_more(spark):
    study = tiny_study(spark)
    month = reach.c1_fast_access(study, 2).agg(F.sum("value")).first()[0]
    assert month < reach.c1_fast_access(study, 30).agg(F.sum("value")).first()[0]


def test_shared_site_ids(spark, rows):
    decoder = spark.createDataFrame([("S", "id10"), ("T", "id10"), ("U", "id11")], "site_name string, program_id string")
    assert rows(reach.shared_site_ids(decoder)) == [("id10", 2)]


def test_baseline(spark):
    export = spark.createDataFrame(
        [("id01", "SUD", 1, "10", "20", "NA", "5", "3"), ("id02", "SUD", 1, "0", "0", "1", ".", "9"), ("id03", "PC", 5, "1", "1", "1", "1", "1")],
        "program_id string, type string, imp_support int, demo_moud_b1_sep2022 string, demo_moud_b2_sep2022 string, "
        "demo_moud_b3_sep2022 string, demo_moud_b4_sep2022 string, demo_moud_a1_sep2022 string",
    )
    got = {(r["program_id"], r["variable"]): r["value"] for r in baseline.baseline_reaim(export).collect()}
    assert got[("id01", "reaim_b1")] == 20 and got[("id01", "reaim_b2")] == 10  # swapped
    assert got[("id01", "reaim_b4")] == 5 and got[("id01", "reaim_b4p")] == 25
    assert got[("id02", "reaim_b4")] == 1 and got[("id02", "reaim_b4p")] is None
    assert ("id03", "reaim_b1") not in got


def test_program_info(spark, rows):
    schema = "program_id string, imp_support int, demo_goal int, demo_level_of_care string"
    sud = spark.createDataFrame([("id01", 1, 1, "1"), ("id02", 1, 2, "35"), ("id03", 1, 3, "2,4"), ("id04", 1, 1, None)], schema)
    pc = spark.createDataFrame([("id60", 1, 1, "5"), ("id61", None, 1, "5")], schema)
    assert rows(baseline.program_info(sud, pc)) == [
        ("id01", "Start MOUD", "SUD", "Outpatient"), ("id02", "Expand MOUD", "SUD", "Inpatient"),
        ("id03", None, "SUD", "Both"), ("id04", "Start MOUD", "SUD", None), ("id60", "Start MOUD", "PC", "Outpatient"),
    ]


def test_registry(spark, rows):
    export = spark.createDataFrame(
        [
            (1, "id01", "sep_2022_arm_1", 1, 2, "", "", None, "x"),
            (2, "id01", "dec_2022_arm_1", None, 2, "amy", "1,3", 2, ""),
            (3, "id01", "dec_2022_arm_1", None, 1, "bob", "1", 1, ""),
            (4, "id02", "dec_2022_arm_1", 5, 2, "cid", "1", 1, ""),
            (5, "id02", "dec_2022_arm_1", None, 2, "cid", "1", 1, ""),
        ],
        "row_id int, program_id string, event_name string, imp_support int, form_complete int, pr_moud_prescriber_1 string, "
        "pr_moud_prescriber_mo_1 string, pr_moud_prescriber_relat_1 int, pr_id string",
    )
    clean = registry.registry_cleanup(export, ["row_id"])
    assert rows(clean, "row_id", "imp_support", "pr_id") == [(1, 1, "x"), (2, 1, None)]
    assert rows(registry.provider_months(clean)) == [("id01", D(2022, 9, 1), 1, 1), ("id01", D(2022, 11, 1), 1, 1)]
    assert rows(registry.patient_rows(clean), "row_id") == [(1,)]
    assert not [c for c in registry.patient_rows(clean).columns if "prescriber" in c]


def test_pivot_fills_absent_cells_only(spark, rows):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", None), ("b", "x", 2.0)], "id string, k string, v double")
    assert rows(R.pivot(df, ["id"], "k", "v", ["x", "y"], fill=0.0)) == [("a", 1.0, None), ("b", 2.0, 0.0)]
    back = R.melt(R.pivot(df, ["id"], "k", "v", ["x", "y"]), ["id"], ["x", "y"], "k", "v", drop_null=True)
    assert rows(back) == [("a", "x", 1.0), ("b", "x", 2.0)]


def test_densify(spark, rows):
    df = spark.createDataFrame([("a", "m", 1, 5), ("b", "m", 2, None), ("a", "n", 3, 7)], "id string, f string, k int, v int")
    assert rows(R.densify(df, ["id", "f"], "k", "v", 0, within=["f"])) == [
        ("a", "m", 1, 5), ("a", "m", 2, 0), ("a", "n", 3, 7), ("b", "m", 1, 0), ("b", "m", 2, None),
    ]
    assert R.densify(df, ["id", "f"], "k", "v").count() == 9


def test_reshape_names(spark, rows):
    df = spark.createDataFrame([(1, "5", "na")], "id int, d_b1_sep string, d_b2_oct string")
    assert rows(R.melt_split(df, ["id"], ["d_b1_sep", "d_b2_oct"], "d_", "_", ["v", "m"])) == [(1, "b1", "sep", 5.0)]
    with pytest.raises(ValueError):
        R.find_blocks(spark.createDataFrame([(1, 2, 3)], "p_1 int, q_1 int, p_2 int"), r"([a-z]+)_(\d+)")
    boxes = spark.createDataFrame([(1, 1, 0, None), (2, None, None, None), (3, 1, 1, 1)], "id int, g___1 int, g___2 int, g___3 int")
    assert rows(R.unite_onehot(boxes, "g___", "g")) == [(1, "1"), (2, ""), (3, "1_2_3")]


def test_rename_checks_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `b.c` int")
    assert S.rename_map(df, {"a": "b.c", "b.c": "a"}).columns == ["b.c", "a"]
    with pytest.raises(ValueError):
        S.rename_map(df, {"z": "y"})


def test_latest_keeps_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), (None, 5, 4)], "k string, d int, v int")
    assert rows(A.latest_per_key(df, ["k"], "d")) == [("a", 2, 2), ("a", 2, 3), (None, 5, 4)]
    assert rows(A.latest(df, "d")) == [(None, 5, 4)]


def test_lookup_matches_missing_keys(spark, rows):
    facts = spark.createDataFrame([("a",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 1), (None, 2)], "code string, v int")
    assert rows(S.left_lookup(facts, dim, [("k", "code")])) == [("a", 1), (None, 2)]


def test_small_side_is_only_marked_when_small(spark):
    df = spark.range(100)
    assert "ResolvedHint" in S.small_side(df)._jdf.queryExecution().analyzed().toString()
    assert S.small_side(df, 50) is df


def test_manual_rows_replace_baseline(spark, rows):
    schema = "date string, program_id string, variable string, value double, type string"
    base = spark.createDataFrame([("d", "a", "reaim_b1", 1.0, "PC"), ("d", "a", "imat_d1", 2.0, "PC"), ("d", "b", "reaim_b1", 3.0, "PC")], schema)
    new = spark.createDataFrame([("d", "a", "reaim_b1", 9.0, "PC")], schema)
    assert rows(combine.manual_override(base, new), "program_id", "variable", "value") == [
        ("a", "imat_d1", 2.0), ("a", "reaim_b1", 9.0), ("b", "reaim_b1", 3.0)
    ]
    assert replace_by_key(base, new.limit(0), "program_id", "imat_").count() == 3


def test_c1_correction(spark, rows):
    data = [("id01", m, "PC", v, x) for m in ("Sep-22", "Dec-22", "Mar-23") for v, x in [("reaim_c1", "50"), ("reaim_b2", "8"), ("reaim_b4", "4")]]
    df = spark.createDataFrame(data, "program_id string, date string, type string, variable string, final_value string")
    out = combine.c1_correction(df, ["reaim_b2", "reaim_b4", "reaim_c1"])
    assert rows(out.filter("variable = 'reaim_c1'"), "date", "final_value") == [("Dec-22", 50.0), ("Sep-22", 1.0)]


def test_report_prefers_newer_measures(spark, rows):
    d1, d2 = D(2022, 9, 1), D(2022, 10, 1)
    data = [(d, "n", v, x) for d in (d1, d2) for v, x in [("reaim_b1", 1.0), ("reaim_b2", 10.0), ("reaim_b4", 1.0), ("reaim_b5", 8.0), ("reaim_b5p", 80.0)]]
    data += [(d1, "o", v, x) for v, x in [("reaim_b1", 4.0), ("reaim_b2", 9.0), ("reaim_b4", 2.0), ("reaim_b4p", 50.0)]]
    long = spark.createDataFrame(data, "date date, program_id string, variable string, value double")
    assert rows(reports.report_moud(long), "program_id", "date", "numer", "denom", "percent", "target_x", "target_y") == [
        ("n", d1, 8.0, 10.0, 80.0, d2, 65), ("n", d2, 8.0, 10.0, 80.0, d2, 65), ("o", d1, 2.0, 4.0, 50.0, d1, 85),
    ]


def test_fixed_values():
    assert len(fixed.SURVEY_ITEMS) == 42 and len({s for _, _, s, _ in fixed.SURVEY_ITEMS}) == 8
    assert [i for _, i, _, r in fixed.SURVEY_ITEMS if r] == ["cdi_inner_12", "cdi_inner_15", "cdi_patient_4"]
    assert [q for q, *_ in fixed.SURVEY_ITEMS] == [f"{n:02d}" for n in range(1, 43)]
