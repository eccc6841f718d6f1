"""Statistics against numpy and brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelens.operators import aggs as A
from carelens.operators import cluster as C
from carelens.operators import stats as S


def ranks(x):
    x = np.asarray(x, float)
    return np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])


def test_spearman_with_ties_and_missing_pairs(spark):
    rnd = random.Random(2)
    data = [(g, rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, 1.0, 2.5, 3.0])) for g in "ab" for _ in range(300)]
    df = spark.createDataFrame(data, "g string, x int, y double")
    for r in S.spearman_by(df, ["g"], "x", "y").collect():
        pairs = [(x, y) for g, x, y in data if g == r["g"] and x is not None and y is not None]
        want = np.corrcoef(ranks([p[0] for p in pairs]), ranks([p[1] for p in pairs]))[0, 1]
        assert r["n"] == len(pairs) and r["cor"] == pytest.approx(want, abs=1e-9)


def test_spearman_perfect_and_short(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 9.0), (4.0, 10.0)], "x double, y double")
    r = S.spearman_by(df, [], "x", "y").first()
    assert r["cor"] == pytest.approx(1) and r["p_val"] == pytest.approx(2 / 24)  # two of the orders of four
    assert S.spearman_by(df.limit(2), [], "x", "y").first()["p_val"] == pytest.approx(1)
    tied = df.union(df)
    assert S.spearman_by(tied, [], "x", "y").first()["p_val"] == pytest.approx(0, abs=1e-9)
    assert S.spearman_by(df.limit(1), [], "x", "y").first()["p_val"] is None


def test_spearman_of_more_pairs_than_the_cube_root_of_a_long(spark):
    """From 2,097,152 pairs on, n ** 3 is no long; a group of a few pairs beside it keeps its exact p."""
    m = 2_200_000
    ids = np.arange(m)
    x, y = ids % 7, np.where(ids % 500 == 0, ids % 7, ids // 7 % 5)

    def mean_ranks(v):
        _, at, n = np.unique(v, return_inverse=True, return_counts=True)
        return (np.cumsum(n) - (n - 1) / 2)[at]

    cor = np.corrcoef(mean_ranks(x), mean_ranks(y))[0, 1]
    p = math.erfc(abs(cor * math.sqrt((m - 2) / (1 - cor * cor))) / math.sqrt(2))
    big = spark.range(m).selectExpr("'big' AS g", "id % 7 AS x", "if(id % 500 = 0, id % 7, id div 7 % 5) AS y")
    few = spark.createDataFrame([("few", 1, 2), ("few", 2, 4), ("few", 3, 9), ("few", 4, 10)], "g string, x long, y long")
    got = {r["g"]: r for r in S.spearman_by(big.union(few), ["g"], "x", "y").collect()}
    assert got["big"]["n"] == m and got["big"]["cor"] == pytest.approx(cor, abs=1e-9)
    assert 1e-4 < p < 0.9 and got["big"]["p_val"] == pytest.approx(p, rel=1e-4)
    assert got["few"]["p_val"] == pytest.approx(2 / 24)


@pytest.mark.parametrize("accuracy", [4, 50, 10_000])
def test_quantiles_from_brackets(spark, monkeypatch, accuracy):
    """Brackets of any width give the exact values; ties, one value only, and both ends among the wanted places."""
    monkeypatch.setattr(A, "ACCURACY", accuracy)
    monkeypatch.setattr(A, "MARGIN", 4 / accuracy)
    rnd = random.Random(accuracy)
    data = [("wide", rnd.gauss(0, 1)) for _ in range(3000)] + [("ties", float(rnd.randrange(5))) for _ in range(700)] + [("one", 2.0)] * 90 + [("few", float(i)) for i in range(7)]
    df = spark.createDataFrame([*data, ("few", None), ("none", None)], "g string, x double").repartition(5)
    probs = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.52, "f": 1.0}
    got = {r["g"]: r for r in A.quantiles_by(df, ["g"], "x", probs).collect()}
    assert set(got) == {"wide", "ties", "one", "few"}
    for g, r in got.items():
        x = [v for k, v in data if k == g]
        assert [r[n] for n in probs] == pytest.approx([np.quantile(x, p) for p in probs.values()])


@pytest.mark.parametrize("n", [1, 2, 5, 400])
def test_quantiles_and_moments(spark, n):
    rnd = random.Random(n)
    data = [(g, rnd.choice([None, rnd.randrange(50) / 4])) for g in "abc" for _ in range(n)] + [("empty", None)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: r for r in A.describe_by(df, ["g"], "x").collect()}
    quart = {r["g"]: r for r in A.quantiles_by(df, ["g"], "x", {"a": 0.25, "b": 0.75}).collect()}
    assert got["empty"]["mean"] is None and got["empty"]["median"] is None
    for g in "abc":
        x = [v for k, v in data if k == g and v is not None]
        if not x:
            continue
        assert got[g]["mean"] == pytest.approx(np.mean(x)) and got[g]["median"] == pytest.approx(np.median(x))
        assert (got[g]["min"], got[g]["max"]) == (min(x), max(x))
        if len(x) > 1:
            assert got[g]["sd"] == pytest.approx(np.std(x, ddof=1), abs=1e-9)
        else:
            assert got[g]["sd"] is None
        assert quart[g]["a"] == pytest.approx(np.quantile(x, 0.25)) and quart[g]["b"] == pytest.approx(np.quantile(x, 0.75))


def test_linear_grid(spark):
    rnd = np.random.default_rng(1)
    x, z = rnd.normal(size=30), rnd.normal(size=30)
    y = 2 * x + rnd.normal(size=30)
    df = spark.createDataFrame([tuple(map(float, t)) for t in zip(y, x, z)], "y double, x double, z double")
    got = {r["exposure"]: r for r in S.linear_grid(df, ["y"], ["x", "z"]).collect()}
    for name, v in (("x", x), ("z", z)):
        assert got[name]["estimate"] == pytest.approx(np.polyfit(v, y, 1)[0])
    assert got["x"]["p_val"] < 1e-6 < got["z"]["p_val"]


def test_random_intercept_on_a_balanced_design(spark):
    """With equal cluster sizes the test is the t test on cluster means."""
    rnd = np.random.default_rng(4)
    data, means = [], {0: [], 1: []}
    for c in range(12):
        kind = c % 2
        y = 3 + 0.8 * kind + rnd.normal() + rnd.normal(size=6)
        means[kind].append(y.mean())
        data += [("q", f"c{c}", float(kind), float(v)) for v in y]
    df = spark.createDataFrame(data, "q string, c string, x double, y double")
    r = S.random_intercept_by(df, ["q"], "y", "x", "c").first()
    a, b = np.array(means[0]), np.array(means[1])
    pooled = (a.var(ddof=1) * 5 + b.var(ddof=1) * 5) / 10
    assert r["estimate"] == pytest.approx(b.mean() - a.mean(), abs=1e-9)
    assert r["t_value"] == pytest.approx((b.mean() - a.mean()) / np.sqrt(pooled * (2 / 6)), rel=1e-7)
    assert r["n_clusters"] == 12 and r["df"] == pytest.approx(10, rel=1e-5)


def test_random_intercept_of_far_apart_clusters(spark):
    """Clusters a thousand times as far apart as their rows; rows without any spread; and no clusters at all."""
    rnd = np.random.default_rng(6)
    data = []
    for q, between, within in (("far", 1000.0, 1.0), ("rigid", 1.0, 0.0), ("none", 0.0, 1.0)):
        for c in range(10):
            level = between * rnd.normal()
            noise = rnd.normal(size=6)
            noise -= noise.mean() if q == "none" else 0.0
            data += [(q, f"c{c}", float(c % 2), float(5 + level + within * e)) for e in noise]
    df = spark.createDataFrame(data, "q string, c string, x double, y double")
    fits = {r["q"]: r for r in S.random_intercept_by(df, ["q"], "y", "x", "c").collect()}
    for q in ("far", "rigid"):
        means = {c: np.mean([y for p, d, _, y in data if p == q and d == f"c{c}"]) for c in range(10)}
        a, b = (np.array([means[c] for c in range(10) if c % 2 == k]) for k in (0, 1))
        pooled = (a.var(ddof=1) * 4 + b.var(ddof=1) * 4) / 8
        want = (b.mean() - a.mean()) / np.sqrt(pooled * (2 / 5))
        assert fits[q]["estimate"] == pytest.approx(b.mean() - a.mean(), rel=1e-6)
        if q == "far":
            assert fits[q]["t_value"] == pytest.approx(want, rel=1e-6) and fits[q]["df"] == pytest.approx(8, rel=1e-4)
    assert fits["rigid"]["df"] == pytest.approx(8)
    assert fits["none"]["df"] == 58


def brute_rank_p(x, y):
    """Two-sided p over all orders of y, as twice the smaller tail."""
    n = len(x)
    ranks = lambda v: [sorted(v).index(e) + 1 for e in v]
    rx, ry = ranks(x), ranks(y)
    s = sum((a - b) ** 2 for a, b in zip(rx, ry))
    every = [sum((a - b) ** 2 for a, b in zip(rx, p)) for p in itertools.permutations(range(1, n + 1))]
    tail = sum(e >= s for e in every) if s > (n**3 - n) / 6 else sum(e <= s for e in every)
    return min(1, 2 * tail / len(every))


@pytest.mark.parametrize("n", [3, 5, 7])
def test_untied_ranks_of_small_samples(spark, n):
    rnd = random.Random(n)
    for _ in range(3):
        x, y = rnd.sample(range(100), n), rnd.sample(range(100), n)
        df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
        assert S.spearman_by(df, [], "x", "y").first()["p_val"] == pytest.approx(brute_rank_p(x, y))


def test_rank_series_continues_the_exact_counts(spark, monkeypatch):
    """The series used from ten pairs on is close to the counts where both can be had."""
    x, y = list(range(9)), [4, 0, 7, 1, 3, 8, 2, 6, 5]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    exact = S.spearman_by(df, [], "x", "y").first()["p_val"]
    monkeypatch.setattr(S, "EXACT_RANKS", 2)
    assert S.spearman_by(df, [], "x", "y").first()["p_val"] == pytest.approx(exact, rel=0.05)
    assert exact == pytest.approx(brute_rank_p(x, y))


def test_random_intercept_weights(spark):
    data = [("q", f"c{i % 7}", float(i % 7 % 2), i % 5) for i in range(200)]
    df = spark.createDataFrame(data, "q string, c string, x double, y int")
    counts = df.groupBy("q", "c", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    one = S.random_intercept_by(df, ["q"], "y", "x", "c").first()
    two = S.random_intercept_by(counts, ["q"], "y", "x", "c", "n").first()
    assert one["t_value"] == pytest.approx(two["t_value"], rel=1e-9)


def test_alpha_and_pca(spark):
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(80, 1))
    x = base + rnd.normal(size=(80, 4)) * [0.5, 1, 2, 3]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(1.0, None, 1.0, 1.0)], "a double, b double, c double, d double")
    alpha = S.cronbach_alpha(df, list("abcd")).first()
    want = 4 / 3 * (1 - x.var(axis=0, ddof=1).sum() / x.sum(axis=1).var(ddof=1))
    assert alpha["n"] == 80 and alpha["alpha"] == pytest.approx(want)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    for j, r in enumerate(S.pca(df, list("abcd")).collect()):
        v = vectors[:, -1 - j]
        v = v * np.sign(v[np.abs(v).argmax()])
        assert r["sd"] == pytest.approx(np.sqrt(values[-1 - j]))
        assert [r[c] for c in "abcd"] == pytest.approx(list(v), abs=1e-6)


def brute_complete(d, names):
    """Merge the closest two clusters until one is left; ties go to the smaller ids."""
    clusters = {n: [n] for n in names}
    merges, order = [], {n: [n] for n in names}

    def far(a, b):
        return max(d[tuple(sorted((x, y)))] for x in clusters[a] for y in clusters[b])

    while len(clusters) > 1:
        h, a, b = min((far(a, b), a, b) for a, b in itertools.combinations(sorted(clusters), 2))
        merges.append((a, b, round(h, 9)))
        clusters[a] += clusters.pop(b)
        order[a] += order.pop(b)
    return merges, order[min(names)]


@pytest.mark.parametrize("n,seed", [(2, 1), (9, 2), (24, 3)])
def test_clustering_against_brute_force(spark, n, seed):
    rnd = random.Random(seed)
    names = [f"id{i:02d}" for i in range(n)]
    d = {p: rnd.random() for p in itertools.combinations(names, 2)}
    df = spark.createDataFrame([(*p, v) for p, v in d.items()], "site_a string, site_b string, distance double")
    merges, leaves = C.hclust_complete(df)
    want, order = brute_complete(d, names)
    assert sorted((r[0], r[1], round(r[2], 9)) for r in merges.collect()) == sorted(want)
    assert [r["site"] for r in leaves.orderBy("position").collect()] == order


def test_distance_drops_features_missing_anywhere(spark):
    rnd = np.random.default_rng(7)
    x = rnd.normal(size=(11, 5))
    data = [(f"id{i:02d}", *map(float, r)) for i, r in enumerate(x)]
    data[3] = (*data[3][:5], None)
    df = spark.createDataFrame(data, "site string, a double, b double, c double, d double, e double")
    got = {(r[0], r[1]): r[2] for r in C.corr_distance(df, "site", list("abcde"), blocks=3).collect()}
    want = 1 - np.corrcoef(x[:, :4])
    assert len(got) == 11 * 10 / 2
    for (p, q), v in got.items():
        assert v == pytest.approx(want[int(p[2:]), int(q[2:])], abs=1e-9)


def test_random_intercept_is_the_same_to_the_last_bit(spark):
    """Ten runs over rows in other orders and partitions, counted or not: equal bits."""
    rnd = np.random.default_rng(11)
    for kind, draw in (("double", lambda: float(np.round(rnd.normal(3, 2), 3)) / 7), ("int", lambda: int(rnd.integers(1, 9)))):
        data = [(f"q{i % 3}", f"c{i % 13}", float(i % 13 % 2) if kind == "double" else i % 13 % 2, draw()) for i in range(400)]
        data += data[:90]
        df = spark.createDataFrame(data, f"q string, c string, x {kind}, y {kind}")
        seen = set()
        for run in range(10):
            rows = df.repartition(1 + run * 2, F.rand(run))
            if run % 2:
                rows = rows.groupBy("q", "c", "x", "y").agg(F.count(F.lit(1)).alias("n"))
            found = S.random_intercept_by(rows, ["q"], "y", "x", "c", "n" if run % 2 else None)
            seen.add(tuple(sorted(map(tuple, found.collect()))))
        assert len(seen) == 1 and len(next(iter(seen))) == 3


def test_random_intercept_without_groups_and_on_odd_rows(spark):
    data = [("q", f"c{i % 7}", float(i % 7 % 2), (i * 7 % 5) * 1e9 + i) for i in range(60)]
    odd = data + [("q", None, None, 1.0), ("q", "c1", 1.0, None), ("q", "c1", float("nan"), 2.0), ("only", "c1", 1.0, 2.0), ("flat", "c1", 1.0, 2.0), ("flat", "c2", 1.0, 3.0), ("flat", "c3", 1.0, 4.0)]
    schema = "q string, c string, x double, y double"
    one = S.random_intercept_by(spark.createDataFrame(data, schema), [], "y", "x", "c").collect()
    many = S.random_intercept_by(spark.createDataFrame(odd, schema), ["q"], "y", "x", "c").collect()
    assert len(one) == 1 and [tuple(r)[1:] for r in many] == [tuple(one[0])]
    scaled = spark.createDataFrame([(q, c, x, y * 1e-12) for q, c, x, y in data], schema)
    small = S.random_intercept_by(scaled, [], "y", "x", "c").first()
    assert small["t_value"] == pytest.approx(one[0]["t_value"], rel=1e-9) and small["df"] == pytest.approx(one[0]["df"], rel=1e-6)
    assert S.random_intercept_by(spark.createDataFrame([], schema), ["q"], "y", "x", "c").collect() == []


def test_derivatives_of_the_criterion(spark):
    """The closed forms beside differences of the criterion."""
    from carelens.operators import mixed

    rnd = np.random.default_rng(3)
    data = [("q", f"c{c}", float(c % 2), float(rnd.normal() + c % 4)) for c in range(9) for _ in range(2 + c % 3)]
    df = spark.createDataFrame(data, "q string, c string, x double, y double")
    sizes = mixed._by_size(mixed._cluster_sums(df, ["q"], "y", "x", "c", None), ["q"])
    step = 1e-3
    for at in (-4.0, -1.0, 0.0, 2.0, 9.0):
        points = [sizes.select(F.expr(mixed._fit(f"{at + k * step!r}D", bends=True)).alias("f")).first()["f"] for k in (-1, 0, 1)]
        low, mid, high = (f["criterion"] for f in points)
        assert points[1]["d1"] == pytest.approx((high - low) / (2 * step), rel=1e-4, abs=1e-6)
        assert points[1]["d2"] == pytest.approx((high - 2 * mid + low) / step**2, rel=1e-3, abs=1e-4)
        assert points[1]["d2"] == pytest.approx((points[2]["d1"] - points[0]["d1"]) / (2 * step), rel=1e-4, abs=1e-7)


def test_exact_sums_in_any_order(spark):
    from fractions import Fraction

    from carelens.operators.exact import exact_sum, power_above

    assert [power_above(v) for v in (None, 0.0, 1.0, 1.5, 8.0, 0.3, 2.0**-40, float("inf"))] == [1.0, 1.0, 1.0, 2.0, 8.0, 0.5, 2.0**-40, 1.0]
    values = [float(v) for v in np.random.default_rng(2).normal(size=5000) / 8] + [1.0, -1.0, 1e-9, 2.0**-72]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    seen = {df.repartition(n, F.rand(n)).agg(exact_sum(F.col("v"))).first()[0] for n in range(1, 9)}
    assert len(seen) == 1 and abs(Fraction(next(iter(seen))) - sum(map(Fraction, values))) < 2.0**-45


def test_ranks_by_refined_histograms(spark, monkeypatch):
    """Any doubles, with bins so few and limits so small that many rounds are needed; beside whole sorts."""
    from carelens.operators import selection

    rnd = np.random.default_rng(8)
    groups = {
        "wide": rnd.normal(size=900), "tiny": 1 + rnd.random(800) * 1e-12, "far": np.exp(rnd.normal(size=700) * 200), "signs": np.concatenate([-np.exp(rnd.normal(size=90) * 9), [0.0, -0.0, 5e-324, -5e-324]]),
        "ties": rnd.integers(0, 4, 500).astype(float), "one": np.array([3.25]), "two": np.array([-1e308, 1e308]), "ends": np.array([1.0] * 300 + [2.0]), None: rnd.normal(size=50),
    }
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("ties", None), ("none", None), ("none", None)]
    df = spark.createDataFrame(data, "g string, _v double").repartition(6)
    probs = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.777, "f": 1.0}
    for bins, few in ((4096, 100_000), (4096, 0), (16, 0), (2, 30)):
        monkeypatch.setattr(selection, "BINS", bins), monkeypatch.setattr(selection, "FEW", few)
        got = {r["g"]: r for r in selection.ranked_summary(df, ["g"], probs).collect()}
        assert set(got) == {*groups, "none"}
        assert (got["none"]["_total"], got["none"]["_missing"], got["none"]["d"], got["ties"]["_missing"]) == (0, 2, None, 1)
        for g, x in groups.items():
            r, x = got[g], np.sort(x)
            for name, p in probs.items():
                spot = (len(x) - 1) * p
                lo, hi = float(x[int(np.floor(spot))]), float(x[int(np.ceil(spot))])
                assert r[name] == (lo if lo == hi else lo + (spot - np.floor(spot)) * (hi - lo)), (g, name)
            assert (r["min"], r["max"], r["_total"]) == (x[0], x[-1], len(x))
            if g not in ("two", "far"):
                assert r["mean"] == pytest.approx(x.mean(), rel=1e-12, abs=1e-12) and r["_ss"] == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-6)


def test_ranks_with_infinities_and_changed_input(spark, monkeypatch):
    from carelens.operators import selection

    values = [float("inf"), float("-inf"), float("nan"), 1.0, 2.0, 3.0, 4.0]
    df = spark.createDataFrame([("g", v) for v in values], "g string, _v double")
    r = selection.ranked_summary(df, ["g"], {"a": 0.0, "b": 0.5, "c": 5 / 6}).first()
    assert (r["a"], r["b"], r["c"]) == (float("-inf"), 3.0, float("inf"))
    moving = spark.range(5000).select(F.lit("g").alias("g"), F.rand().alias("_v"))
    spark_rand = moving.withColumn("_v", F.col("_v") + F.unix_micros(F.current_timestamp()) * 1e-3)
    monkeypatch.setattr(selection, "FEW", 0)
    with pytest.raises(RuntimeError, match="bracket"):
        selection.ranked_summary(spark_rand, ["g"], {"m": 0.5})


def test_a_rank_outside_its_bracket_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(A, "ACCURACY", 100)
    monkeypatch.setattr(A, "MARGIN", -0.1)  # brackets that end before they begin
    df = spark.createDataFrame([("g", float(i % 997)) for i in range(3000)], "g string, x double")
    with pytest.raises(Exception, match="not in its bracket"):
        A.quantiles_by(df, ["g"], "x", {"m": 0.5}).collect()
