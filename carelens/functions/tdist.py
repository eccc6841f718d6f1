"""Tail probabilities of the t and normal distributions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places and weights of a double-exponential rule for integrals from 0 to infinity: s = exp(pi/2 sinh(u)), u in steps of 1/16.
_STEP = 1 / 16
_NODES = [
    (s, _STEP * math.pi / 2 * math.cosh(k * _STEP) * s)
    for k in range(-72, 73)
    for s in [math.exp(math.pi / 2 * math.sinh(k * _STEP))]
]
_RULE = "array(" + ", ".join(f"named_struct('s', {s!r}D, 'w', {w!r}D)" for s, w in _NODES) + ")"


def _integral(fall) -> Column:
    """Integral over s from 0 of exp(-fall(s)), for an increasing fall that is 0 at 0 and near 1 at 1."""
    return F.aggregate(F.expr(_RULE), F.lit(0.0), lambda acc, node: acc + node["w"] * F.exp(-fall(node["s"])))


def two_sided_p(t: Column, df: Column) -> Column:
    """P(|T| > |t|) for any positive degrees of freedom, whole or not.

    The upper tail itself is integrated, relative to its height at t, and
    divided by the same integral from 0; so there is one formula for all
    degrees of freedom, and small probabilities keep their digits.
    """
    t, n = F.abs(t.cast("double")), df.cast("double")
    half = (n + 1) / 2
    scale = 1 / ((n + 1) * t / (n + t * t) + 1 / (1 + t))

    def past(s):
        x = scale * s
        return half * F.log1p((2 * t * x + x * x) / (n + t * t))

    tail = F.exp(-half * F.log1p(t * t / n)) * scale * _integral(past)
    whole = _integral(lambda s: half * F.log1p(s * s / n))
    return (
        F.when((n <= 0) | t.isNull() | F.isnan(t), F.lit(None).cast("double"))
        .when(t == float("inf"), 0.0)
        .otherwise(F.least(tail / whole, F.lit(1.0)))
    )


def normal_tail(x: Column) -> Column:
    """P(Z > x)."""
    t = F.abs(x.cast("double"))
    scale = 1 / (1 + t)
    upper = F.exp(-t * t / 2) * scale * _integral(lambda s: t * scale * s + scale * scale * s * s / 2) / math.sqrt(2 * math.pi)
    return F.when(x >= 0, upper).otherwise(1 - upper)
