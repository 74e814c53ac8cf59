"""Lenient number parsing."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)\s*$"
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
LARGEST = sys.float_info.max


def to_number(value: Column) -> Column:
    """The text as a double, null where it is no number.

    The pattern keeps out what Spark's cast takes and a CSV reader does not (``5d``, ``0x1p3``,
    ``NaN``); most other text is ruled out by its first byte. Digits beyond the range of a double
    give infinity; see ``is_number``.
    """
    starts_like_one = (value < ":") | value.startswith("i") | value.startswith("I")
    return F.when(starts_like_one & value.rlike(NUMBER), value.try_cast("double"))


def is_number(value: Column, number: Column) -> Column:
    """Whether ``number``, read from ``value``, counts: infinity does so only if spelled out."""
    return number.isNotNull() & ((F.abs(number) <= LARGEST) | ~value.rlike("[0-9]"))


def is_integer(value: Column, number: Column) -> Column:
    """Whether ``number``, read from ``value``, is written as an integer of 64 bits."""
    fits = value.try_cast("bigint").isNotNull()
    return number.isNotNull() & value.rlike(INTEGER) & fits


def is_boolean_text(value: Column) -> Column:
    return value.isin("True", "TRUE", "true", "False", "FALSE", "false")


def percent(part: Column, whole: Column) -> Column:
    """Percent with two decimals, 0 where there is no whole."""
    return F.when(whole > 0, F.round(100 * part / whole, 2)).otherwise(F.lit(0.0))
