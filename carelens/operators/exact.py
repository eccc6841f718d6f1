"""Sums of floating numbers that come out the same to the last bit in any order of addition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = {"tinyint", "smallint", "int", "bigint"}


def power_above(top: float | None) -> float:
    """The smallest power of two that is no smaller than a number, 1 for none or zero."""
    power = 1.0
    if top is None or not 0 < top < float("inf"):
        return power
    while power < top:
        power *= 2
    while power / 2 >= top:
        power /= 2
    return power


def exact_sum(v: Column, bits: int = 24, limbs: int = 3) -> Column:
    """Aggregate: the sum of numbers of about -1 to 1, each split into whole limbs whose sums are exact.

    A number is taken to ``bits * limbs`` binary places; the limbs add up as longs, so no order of addition shows.
    There is room for weights of 2 ^ (63 - bits) in all; beyond that the sum is an error, not a wrong number.
    """
    rest, parts = v, []
    for i in range(1, limbs + 1):
        rest = rest * float(2**bits)
        whole = F.rint(rest)
        parts.append(F.sum(whole.cast("long")).cast("double") * 2.0 ** (-bits * i))
        rest = rest - whole
    return reduce(lambda a, b: a + b, reversed(parts))
