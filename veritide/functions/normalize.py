"""Bring phones, dates and names into one format; blanks and hopeless values stay as they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritide.functions.dates import read_any_date
from veritide.functions.text import is_present, title_case, unless_blank


def normalize_phone(value: Column) -> Column:
    """Ten digits, after a leading 1 is taken off eleven, become ``XXX-XXX-XXXX``."""
    digits = F.regexp_replace(value, r"(?U)\D", "")
    with_country = (F.length(digits) == 11) & digits.startswith("1")
    national = F.when(with_country, F.substring(digits, 2, 10)).otherwise(digits)
    dashed = F.concat_ws(
        "-", F.substring(national, 1, 3), F.substring(national, 4, 3), F.substring(national, 7, 4)
    )
    return F.when(is_present(value) & (F.length(national) == 10), dashed).otherwise(value)


def normalize_date(value: Column) -> Column:
    return F.coalesce(read_any_date(value).cast("string"), value)


def normalize_name(value: Column) -> Column:
    return unless_blank(value, title_case(value))


# Column and what brings it into form.
NORMALIZERS = {
    "phone": normalize_phone,
    "date_of_birth": normalize_date,
    "created_date": normalize_date,
    "first_name": normalize_name,
    "last_name": normalize_name,
}
