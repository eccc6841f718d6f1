"""Ordered operators: cutting a heavy key must not change any result."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from carelens.operators import ordered as O
from carelens.operators import windows as W
from carelens.operators.joins import asof_forward, asof_hot_input, overlap_months

D = datetime.date


def events(spark, n=3000, seed=1):
    """One key holds a third of the rows, one key is null, dates tie and are missing."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.34 else rnd.choice([None, *[f"k{j}" for j in range(40)]])
        day = None if rnd.random() < 0.01 else D(2022, 1, 1) + datetime.timedelta(days=rnd.randrange(400))
        rows.append((key, day, i, rnd.choice([None, 1, 2, 3]), rnd.choice([None, 30.0, 60.0])))
    return spark.createDataFrame(rows, "key string, day date, id int, v int, supply double")


def steps():
    return {
        "before": O.prev(F.col("v")),
        "after": O.next_(F.col("v")),
        "total": O.running_sum(F.col("v")),
        "known": O.last_known(F.col("v")),
        "coming": O.next_known(F.col("v")),
        "seen": O.prev(F.lit(True)),
    }


def test_heavy_key_is_cut(spark):
    hot = O.find_hot(events(spark), ["key"], ["day", "id"])
    found = {r["_hot_key"]: len(r["_bounds"]) for r in hot.bounds.collect()}
    assert found["hot"] > 20
    # each slice of the heavy key is small
    sliced = O.over_ordered(events(spark), ["key"], ["day", "id"], {"n": O.running_sum(F.lit(1))}, hot)
    assert sliced.filter("key = 'hot'").agg(F.max("n")).first()[0] == events(spark).filter("key = 'hot'").count()


def test_no_heavy_key(spark):
    even = spark.range(2000).select(F.col("id").alias("key"), F.col("id").alias("t"))
    assert O.find_hot(even, ["key"], ["t"]) is None
    assert O.find_hot(even.limit(0), ["key"], ["t"]) is None


@pytest.mark.parametrize("slice_rows", [2, 10])
def test_slices_change_nothing(spark, rows, slice_rows):
    df = events(spark)
    hot = O.find_hot(df, ["key"], ["day", "id"], slice_rows)
    cut = O.over_ordered(df, ["key"], ["day", "id"], steps(), hot)
    plain = O.over_ordered(df, ["key"], ["day", "id"], steps())
    assert cut.columns == plain.columns
    assert rows(cut) == rows(plain)


def test_plain_windows_against_python(spark):
    df = events(spark, 400, 3)
    got = {r["id"]: r for r in O.over_ordered(df, ["key"], ["day", "id"], steps()).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r["key"], []).append(r)
    for group in groups.values():
        group.sort(key=lambda r: (r["day"] is None, r["day"] or D(1, 1, 1), r["id"]))
        for i, r in enumerate(group):
            out = got[r["id"]]
            so_far = [x["v"] for x in group[: i + 1] if x["v"] is not None]
            rest = [x["v"] for x in group[i:] if x["v"] is not None]
            assert out["before"] == (group[i - 1]["v"] if i else None)
            assert out["after"] == (group[i + 1]["v"] if i + 1 < len(group) else None)
            assert out["total"] == (sum(so_far) if so_far else None)
            assert out["known"] == (so_far[-1] if so_far else None)
            assert out["coming"] == (rest[0] if rest else None)
            assert out["seen"] == (True if i else None)


def test_domain_windows_with_a_heavy_patient(spark, rows):
    df = events(spark).filter("day is not null").withColumn("refills", F.col("v"))
    hot = O.find_hot(df, ["key"], ["day", "id"], 3)
    out = []
    for h in (None, hot):
        flagged = W.flag_restarts(df, ["key"], ["day", "id"], "day", "supply", "refills", hot=h)
        broken = W.flag_breaks(flagged, ["key"], ["day", "id"], hot=h)
        spans = W.episodes(broken, ["key"], ["day", "id"], "day", "supply", hot=h)
        numbered = O.row_number(df, ["key"], ["day", "id"], "n", h).select("id", "n")
        out.append((rows(broken, "id", "is_restart", "is_break"), rows(spans), rows(numbered)))
    assert out[0] == out[1]


def test_asof_with_a_heavy_patient(spark):
    left = events(spark, 600, 5).select("key", F.col("day").alias("visit"), "id")
    right = events(spark, 600, 6).select("key", F.col("day").alias("rx"))
    how = (["key"], "visit", "rx", "id")
    hot = O.find_hot(asof_hot_input(left, right, *how), ["key"], ["_date", "_side", "_id"], 3)
    assert hot is not None
    rx = {}
    for r in right.collect():
        if r["rx"]:
            rx.setdefault(r["key"], []).append(r["rx"])
    for h in (None, hot):
        for r in asof_forward(left, right, *how, "near", h).collect():
            later = [d for d in rx.get(r["key"], []) if r["visit"] and d >= r["visit"]]
            assert r["near"] == (min(later) if later else None), r


def test_overlap_touches_month_edges(spark, rows):
    spans = spark.createDataFrame(
        [(1, D(2022, 1, 31), D(2022, 3, 1)), (2, D(2022, 2, 10), None), (3, D(2022, 5, 2), D(2022, 4, 30))],
        "id int, a date, b date",
    )
    seen = spark.createDataFrame([(D(2022, m, 1),) for m in (1, 3, 4, 5)], "month date")
    got = rows(overlap_months(spans, "a", "b", seen, "month"), "id", "month")
    assert got == [(1, D(2022, 1, 1)), (1, D(2022, 3, 1)), (3, D(2022, 4, 1)), (3, D(2022, 5, 1))]
