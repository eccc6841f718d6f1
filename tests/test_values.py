"""Null rules, dates and texts on hand-written values."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from carelens.functions import dates as D
from carelens.functions import nulls as N
from carelens.functions import text as X
from carelens.functions.tdist import normal_tail, two_sided_p

DAY = datetime.date


def test_if_else_is_null_on_null_condition(spark, rows):
    df = spark.createDataFrame([(1,), (0,), (None,)], "x int")
    assert rows(df.select("x", N.if_else(F.col("x") == 1, F.lit("a"), F.lit("b")).alias("r"))) == [
        (0, "b"), (1, "a"), (None, None)
    ]


def test_null_sum_and_percent(spark):
    df = spark.createDataFrame([(None, None), (1, None), (None, 2), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(N.null_sum(F.col("a"), F.col("b"))).collect()] == [None, 1, 2, 3]
    df = spark.createDataFrame([(5, 0), (5, 4), (2, 4), (None, 4), (1, None), (None, 0)], "n int, d int")
    n, d = F.col("n"), F.col("d")
    got = [tuple(r) for r in df.select(N.pct_clamped(n, d), N.pct_zero_default(n, d)).collect()]
    assert got == [(None, 0.0), (100.0, 100.0), (50.0, 50.0), (None, 0.0), (None, None), (None, 0.0)]


def test_strict_aggregates_and_distinct_with_null(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1), ("b", 3)], "g string, x int")
    out = df.groupBy("g").agg(N.strict(F.avg, F.col("x")).alias("m"), N.n_unique(F.col("x")).alias("n"))
    assert rows(out) == [("a", None, 2), ("b", 2.0, 2)]


def test_row_mean_recode_tokens(spark):
    df = spark.createDataFrame([(1, None, 4), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(N.row_mean(["a", "b", "c"])).collect()] == [2.5, None]
    assert [r[0] for r in df.select(N.recode(F.col("a"), {1: "one", 2: "two"})).collect()] == ["one", None]
    texts = spark.createDataFrame([("NA",), ("na",), (".",), (" ",), ("7",), (None,)], "t string")
    got = [r[0] for r in texts.select(N.try_number(N.tokens_to_null(F.col("t"), ["", "NA", "na", "."]))).collect()]
    assert got == [None, None, None, None, 7.0, None]


def test_dates(spark):
    one = spark.range(1)

    def value(col):
        return one.select(col).first()[0]

    assert value(D.month_from_event(F.lit("sep_2022_arm_1"))) == DAY(2022, 9, 1)
    assert value(D.month_from_event(F.lit("nonsense"))) is None
    formats = ["MMM-yy", "MMM-yyyy", "MMM yy", "MMM yyyy"]
    for text, want in [("Sep-22", 2022), ("Sep-2022", 2022), ("Sep 22", 2022), ("Sep 2022", 2022), ("Sep-99", 1999)]:
        assert value(D.parse_date(F.lit(text), formats)) == DAY(want, 9, 1)
    assert value(D.parse_date(F.lit("soon"), formats)) is None
    assert value(D.month_back(F.lit(DAY(2022, 3, 1)), F.lit(1))) == DAY(2021, 12, 1)
    assert value(D.month_label(F.lit(DAY(2022, 9, 1)), "MMM-yy")) == "Sep-22"
    assert value(D.add_days(F.lit(DAY(2022, 9, 1)), F.lit(33.5))) == DAY(2022, 10, 4)


def test_texts(spark):
    one = spark.range(1)

    def value(col):
        return one.select(col).first()[0]

    assert value(X.parse_number(F.lit("1,200 tabs"))) == 1200
    assert value(X.parse_number(F.lit("about 2.5 ml"))) == 2.5
    assert value(X.parse_number(F.lit("none"))) is None
    assert value(X.pad_left(F.lit("12345"), 4)) == "12345"
    assert value(X.pad_left(F.lit("7"), 4)) == "0007"
    assert value(X.nth_part(F.lit("cdi_outer_1"), 2)) == "outer"
    assert value(X.nth_part(F.lit("cdi"), 2)) is None
    assert [value(X.site_type(F.lit(s))) for s in ("id00", "id49", "id50", "id62", "other")] == ["SUD", "SUD", "PC", "PC", "PC"]
    assert value(X.list_position(F.lit("b"), ["a", "b"])) == 2
    assert value(X.list_position(F.lit("z"), ["a", "b"])) is None


def reference_p(t, v, steps=20000):
    """Simpson's rule on the density."""
    c = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
    h = abs(t) / steps
    f = [c * (1 + (i * h) ** 2 / v) ** (-(v + 1) / 2) for i in range(steps + 1)]
    return 1 - 2 * h / 3 * (f[0] + f[-1] + 4 * sum(f[1:-1:2]) + 2 * sum(f[2:-1:2]))


@pytest.mark.parametrize("v", [1, 2, 3, 4, 5, 10, 23, 100, 999, 1000, 1001, 50000])
def test_t_probability(spark, v):
    ts = [0.0, 0.3, 1.0, -1.96, 2.5, 4.0]
    df = spark.createDataFrame([(t,) for t in ts], "t double")
    got = [r[0] for r in df.select(two_sided_p(F.col("t"), F.lit(v))).collect()]
    for t, p in zip(ts, got):
        assert abs(p - reference_p(t, v)) < 1e-7, (t, v, p)


def test_t_probability_far_out(spark):
    """Closed forms for 1, 2 and 4 degrees of freedom, and known values where 1 - x has no digits left."""
    two = lambda t: 2 / (math.sqrt(2 + t * t) * (math.sqrt(2 + t * t) + t))
    want = [(t, v, f(t)) for v, f in ((1, lambda t: 2 / math.pi * math.atan(1 / t)), (2, two)) for t in (1e-3, 0.7, 8.0, 300.0)]
    want += [(9.0, 1000, 1.1129077171871503e-18), (9.0, 1001, 1.1112243175024433e-18), (12.0, 200, 2.4221360052466547e-25)]
    got = [r[0] for r in spark.createDataFrame([(t, v) for t, v, _ in want], "t double, v int").select(two_sided_p(F.col("t"), F.col("v"))).collect()]
    assert all(abs(p / w - 1) < 1e-9 for p, (_, _, w) in zip(got, want)), list(zip(got, want))
    row = spark.range(1).select(
        two_sided_p(F.lit(float("inf")), F.lit(3.5)), two_sided_p(F.lit(2.0), F.lit(3.5)), two_sided_p(F.lit(2.0), F.lit(3)), two_sided_p(F.lit(2.0), F.lit(4)),
        normal_tail(F.lit(1.959963984540054)), normal_tail(F.lit(-1.0)), normal_tail(F.lit(0.0)),
    ).first()
    assert row[0] == 0.0 and row[3] < row[1] < row[2]
    assert row[4] == pytest.approx(0.025) and row[5] == pytest.approx(0.8413447460685429) and row[6] == pytest.approx(0.5)


def test_t_probability_without_freedom(spark):
    assert spark.range(1).select(two_sided_p(F.lit(1.0), F.lit(0))).first()[0] is None
