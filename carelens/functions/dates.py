"""Date and month expressions. Months are DATE values on the first of the month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_from_event(event: Column) -> Column:
    """'sep_2022_arm_1' -> 2022-09-01."""
    return F.to_date(F.try_to_timestamp(F.regexp_extract(event, r"^([A-Za-z]+_\d{4})", 1), F.lit("MMM_yyyy")))


def parse_date(text: Column, formats: list[str]) -> Column:
    """First format which fits wins; null when none does.

    Two-digit years 69 to 99 belong to the 1900s (Spark would read 20xx).
    """

    def read(pattern):
        day = F.to_date(F.try_to_timestamp(text, F.lit(pattern)))
        if "yy" in pattern and "yyyy" not in pattern:
            return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)
        return day

    return F.coalesce(*[read(f) for f in formats])


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_label(d: Column, pattern: str = "MMM yyyy") -> Column:
    return F.date_format(d, pattern)


def month_back(survey_month: Column, code: Column) -> Column:
    """Month a provider code 1..3 refers to: the survey month less (4 - code) months."""
    return F.add_months(survey_month, code - 4)


def month_end(d: Column) -> Column:
    return F.last_day(d)


def days_between(later: Column, earlier: Column) -> Column:
    return F.date_diff(later, earlier)


FIRST_DAY, LAST_DAY = -719162, 2932896  # 0001-01-01 and 9999-12-31, from 1970-01-01


def add_days(d: Column, days: Column) -> Column:
    """Later by whole days; null beyond the calendar (a date of the years 1 to 9999)."""
    whole = F.floor(days.try_cast("double"))
    there = F.unix_date(d) + whole.cast("double")
    return F.when(there.between(FIRST_DAY, LAST_DAY), F.date_add(d, whole.try_cast("int")))
