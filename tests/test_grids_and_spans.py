"""Grids of any number of keys, and pairs of overlapping spans, beside plain loops."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from carelens.operators import cluster, joins, reshape

SPANS = "id int, site string, s int, e int"


def touching(left, right):
    out = Counter()
    for a in left:
        for b in right:
            if a[1] == b[1] and None not in (a[2], a[3], b[2], b[3]):
                (s, e), (u, v) = sorted(a[2:4]), sorted(b[2:4])
                if s <= v and u <= e:
                    out[(*a, *b)] += 1
    return out


@pytest.mark.parametrize("seed, spread, longest", [(1, 40, 6), (2, 4000, 3000), (3, 10, 0), (4, 1_000_000, 200_000), (5, 3, 1)])
def test_pairs_of_overlapping_spans(spark, seed, spread, longest):
    rnd = random.Random(seed)

    def some(n, first):
        out = []
        for i in range(n):
            s = rnd.randint(-spread, spread)
            out.append((first + i, rnd.choice(["hot", "hot", "hot", "b", None]), s, s + rnd.randint(-1, longest) if longest else s))
        return [*out, (first - 1, "hot", None, 4), (first - 2, "hot", 1, None), out[0]]

    left, right = some(60, 100), some(45, 1000)
    got = joins.overlap_join(spark.createDataFrame(left, SPANS), spark.createDataFrame(right, SPANS), ["site"], ("s", "e"))
    assert got.columns == ["id", "site", "s", "e", "right_id", "right_site", "right_s", "right_e"]
    assert Counter(map(tuple, got.collect())) == touching(left, right)


def test_overlapping_spans_without_rows_or_keys(spark):
    one = spark.createDataFrame([(1, "a", 5, 9), (2, "b", 10, 10)], SPANS)
    assert joins.overlap_join(one.limit(0), one, ["site"], ("s", "e")).collect() == []
    assert joins.overlap_join(one, one.limit(0), [], ("s", "e")).collect() == []
    every = joins.overlap_join(one, one.selectExpr("id", "s as u", "e as v"), [], ("s", "e"), ("u", "v"))
    assert sorted((r["id"], r["right_id"]) for r in every.collect()) == [(1, 1), (2, 2)]


def test_months_are_one_use_of_overlapping_spans(spark):
    day = datetime.date
    spans = spark.createDataFrame([(1, day(1969, 11, 20), day(1970, 2, 1)), (2, day(2023, 1, 31), day(2023, 1, 31)), (3, day(2023, 5, 2), day(2023, 3, 30)), (4, None, day(2023, 3, 1))], "id int, s date, e date")
    months = [day(1969, 12, 1), day(1970, 1, 1), day(1970, 2, 1), day(2023, 1, 1), day(2023, 2, 1), day(2023, 3, 1), day(2023, 5, 1)]
    observed = spark.createDataFrame([(m,) for m in months], "month date")
    whole = observed.withColumn("last", F.last_day("month"))
    pairs = joins.overlap_join(spans, whole, [], ("s", "e"), ("month", "last")).select("id", F.col("right_month").alias("month"))
    want = joins.overlap_months(spans, "s", "e", observed, "month").select("id", "month")
    assert Counter(map(tuple, pairs.collect())) == Counter(map(tuple, want.collect())) and want.count() == 6


def test_overlaps_form_no_other_pairs(spark):
    """Every row either join makes is a pair of the result; there is no nested loop."""
    long = spark.range(300).selectExpr("int(id) as id", "'k' as site", "int(id * 7 % 1000) as s", "int(id * 7 % 1000 + id % 90) as e")
    plan = joins.overlap_join(long, long, ["site"], ("s", "e"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_grid_of_many_keys(spark, monkeypatch, block):
    monkeypatch.setattr(reshape, "KEY_BLOCK", block)
    data = [("x", "m1", 1, 5), ("x", "m1", 2, 6), ("y", "m1", 7, 1), ("x", "m2", 9, 2), (None, "m2", 3, 4), ("z", "m2", None, 8), ("z", "m3", None, 8)]
    df = spark.createDataFrame(data, "id string, m string, k int, v int")
    got = Counter(map(tuple, reshape.densify(df, ["id", "m"], "k", "v", 0, within=["m"]).collect()))
    keys = {"m1": [1, 2, 7], "m2": [9, 3]}
    known = {(i, m, k): v for i, m, k, v in data}
    want = Counter((i, m, k, known.get((i, m, k), 0)) for i, m in {(i, m) for i, m, _, _ in data} for k in keys.get(m, []))
    assert got == want
    free = Counter(map(tuple, reshape.densify(df.drop("m"), ["id"], "k", "v", -1).collect()))
    assert sum(free.values()) == 4 * 5 and free[("y", 9, -1)] == 1 and free[(None, 3, 4)] == 1
    assert reshape.densify(df.limit(0), ["id"], "k", "v").collect() == []
    many = spark.range(40).selectExpr("concat('i', id % 4) as id", "id as k", "id as v")
    assert reshape.densify(many, ["id"], "k", "v").count() == 160
    assert "collect_set" not in reshape.densify(many, ["id"], "k", "v")._jdf.queryExecution().optimizedPlan().toString()


def test_tiles_follow_the_number_of_sites(spark, monkeypatch):
    wide = spark.range(30).selectExpr("concat('s', id) as site", "cast(id * 7 % 11 as double) as a", "cast(id * id % 13 as double) as b", "cast(id % 5 as double) as c")
    few = {(r[0], r[1]): r[2] for r in cluster.corr_distance(wide, "site", ["a", "b", "c"], 1).collect()}
    monkeypatch.setattr(cluster, "TILE", 2)
    tiled = {(r[0], r[1]): r[2] for r in cluster.corr_distance(wide, "site", ["a", "b", "c"]).collect()}
    assert len(few) == 30 * 29 // 2 and few == tiled
