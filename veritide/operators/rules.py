"""The rule list: which column must satisfy which check."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritide import contract
from veritide.functions.dates import age_in_years, in_timestamp_range, read_iso_date, resolve_as_of
from veritide.functions.numbers import to_number
from veritide.functions.text import is_present, matches_email, matches_name, matches_phone

REQUIRED = "required"
UNIQUE = "unique"


class Rule(NamedTuple):
    """A named check of one column.

    ``holds`` judges a value that is present, after ``reads`` has read it; ``required`` and
    ``unique`` are not about one present value and have no ``holds``.
    """

    column: str
    check: str
    holds: Callable[[Column], Column] | None = None
    reads: Callable[[Column], Column] | None = None

    @property
    def name(self) -> str:
        return f"{self.column}__{self.check}"

    def verdict(self, present: Column, value: Column) -> Column:
        """True where the row passes, from whether the value is present and the value as read.
        Blanks fail ``required`` only, and nulls no rule at all."""
        if self.check == REQUIRED:
            return F.coalesce(present, F.lit(True))
        holds = self.holds(value)
        return F.when(present, F.coalesce(holds, F.lit(False))).otherwise(F.lit(True))


def positive_integer(number: Column) -> Column:
    return (number % 1 == 0) & (number > 0)


def valid_name(value: Column) -> Column:
    return matches_name(value) & F.length(value).between(*contract.NAME_LENGTH)


def plausible_age(as_of: dt.date | Column | None) -> Callable[[Column], Column]:
    def holds(day: Column) -> Column:
        age = age_in_years(day, resolve_as_of(as_of))
        return in_timestamp_range(day) & age.between(*contract.AGE_RANGE)

    return holds


def valid_address(value: Column) -> Column:
    return F.length(value).between(*contract.ADDRESS_LENGTH)


def income_in_range(number: Column) -> Column:
    return number.between(*contract.INCOME_RANGE)


def valid_status(value: Column) -> Column:
    return value.isin(contract.STATUSES)


def customer_rules(as_of: dt.date | Column | None = None) -> list[Rule]:
    """The 22 checks of the customer table; ages are taken at ``as_of``."""
    age = plausible_age(as_of)
    others = [
        Rule("customer_id", "positive_integer", positive_integer, to_number),
        Rule("customer_id", UNIQUE),
        Rule("first_name", "valid_name", valid_name),
        Rule("last_name", "valid_name", valid_name),
        Rule("email", "valid_email", matches_email),
        Rule("phone", "valid_phone", matches_phone),
        Rule("date_of_birth", "valid_date_format", in_timestamp_range, read_iso_date),
        Rule("date_of_birth", "plausible_age", age, read_iso_date),
        Rule("address", "valid_length", valid_address),
        Rule("income", "in_range", income_in_range, to_number),
        Rule("account_status", "valid_status", valid_status),
        Rule("created_date", "valid_date_format", in_timestamp_range, read_iso_date),
    ]
    return [Rule(column, REQUIRED) for column in contract.COLUMNS] + others
