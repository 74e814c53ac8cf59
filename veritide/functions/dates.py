"""Lenient date parsing and age."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritide import contract

MONTH = "(1[0-2]|0?[1-9])"
DAY = "(3[01]|[12][0-9]|0?[1-9]| [1-9])"
ISO_SHAPE = rf"^[0-9]{{4}}-{MONTH}-{DAY}\z"
# A shape and the pattern that reads it, in the order they are tried after ISO: on 03/04/1985 the US
# order wins. Only text of the right shape reaches the parser, so it seldom has to fail.
OTHER_FORMATS = [
    (rf"^{MONTH}/{DAY}/[0-9]{{4}}\z", "M/d/yyyy"),
    (rf"(?i)^{DAY}-(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)-[0-9]{{4}}\z", "d-MMM-yyyy"),
    (rf"^{DAY}/{MONTH}/[0-9]{{4}}\z", "d/M/yyyy"),
]
# The range of a 64-bit nanosecond timestamp. The rules and the profile take a date
# outside of it for unreadable, the normaliser does not.
FIRST_DATE = dt.date(1677, 9, 22)
LAST_DATE = dt.date(2262, 4, 11)


def read_iso_date(value: Column) -> Column:
    """The text as a date, null if it is none. The cast needs no formatter and no time zone."""
    return _shaped(value, ISO_SHAPE).try_cast("date")


def _shaped(value: Column, shape: str) -> Column:
    """Text of the shape, with a zero for the space that may stand before a one-digit day."""
    return F.when(value.rlike(shape), F.replace(value, F.lit(" "), F.lit("0")))


def read_any_date(value: Column) -> Column:
    """The first of the known formats that reads the text."""
    others = [F.try_to_date(_shaped(value, shape), pattern) for shape, pattern in OTHER_FORMATS]
    return F.coalesce(read_iso_date(value), *others)


def in_timestamp_range(day: Column) -> Column:
    return day.between(F.lit(FIRST_DATE), F.lit(LAST_DATE))


def age_in_years(day: Column, as_of: Column) -> Column:
    return F.datediff(as_of, day) / F.lit(contract.DAYS_PER_YEAR)


def resolve_as_of(as_of: dt.date | Column | None) -> Column:
    """The day ages are taken at; by default the day the query runs."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)
