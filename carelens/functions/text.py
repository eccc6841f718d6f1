"""Text expressions on ids, names and codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(text: Column) -> Column:
    """First number in a text: '1,200 tabs' -> 1200."""
    found = F.regexp_extract(text, r"(-?\d[\d,]*\.?\d*|-?\.\d+)", 1)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("double")


def pad_left(text: Column, width: int, pad: str = "0") -> Column:
    """Left padding that never cuts a longer text."""
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, pad))


def nth_part(text: Column, n: int, sep: str = "_") -> Column:
    """n-th part of a delimited name, null when there are fewer parts."""
    return F.get(F.split(text, sep), n - 1)


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def flatten_lines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def site_type(program_id: Column) -> Column:
    """Site ids 00 to 49 are SUD programmes, all other ids are primary care."""
    return F.when(program_id.rlike(r"^id[0-4][0-9]$"), "SUD").otherwise("PC")


def site_group(program_id: Column, sites: list[str], name: str) -> Column:
    """Listed sites share one group name, any other site is its own group."""
    return F.when(program_id.isin(sites), name).otherwise(program_id)


def list_position(col: Column, ordered: list) -> Column:
    """Position of a label in a given order, null when it is not listed."""
    spot = F.array_position(F.array(*[F.lit(v) for v in ordered]), col)
    return F.when(spot > 0, spot).cast("int")
