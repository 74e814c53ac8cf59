"""Masks; blanks stay blank."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritide import contract
from veritide.functions.text import matches_canonical_phone, matches_iso_shape, unless_blank


def mask_name(value: Column) -> Column:
    return unless_blank(value, F.concat(F.substring(value, 1, 1), F.lit(contract.MASK)))


def mask_email(value: Column) -> Column:
    """First character and domain stay; without a local part nothing does."""
    at = F.instr(value, "@")
    domain = value.substr(at, F.length(value))
    partly = F.concat(F.substring(value, 1, 1), F.lit(contract.MASK), domain)
    return unless_blank(value, F.when(at > 1, partly).otherwise(F.lit(contract.MASK)))


def mask_phone(value: Column) -> Column:
    """The last four digits stay, if there are four."""
    four = F.lit(4)
    digits = F.regexp_replace(value, r"(?U)\D", "")
    masked = (
        F.when(
            matches_canonical_phone(value),
            F.concat(F.lit(contract.MASKED_PHONE_PREFIX), F.right(value, four)),
        )
        .when(F.length(digits) >= 4, F.concat(F.lit(contract.MASK), F.right(digits, four)))
        .otherwise(F.lit(contract.MASK))
    )
    return unless_blank(value, masked)


def mask_address(value: Column) -> Column:
    return unless_blank(value, F.lit(contract.MASKED_ADDRESS))


def mask_date(value: Column) -> Column:
    """The year stays if the text has the ISO shape, valid date or not."""
    year = F.concat(F.substring(value, 1, 4), F.lit(contract.MASKED_MONTH_AND_DAY))
    masked = F.when(matches_iso_shape(value), year).otherwise(F.lit(contract.MASKED_DATE))
    return unless_blank(value, masked)


# Column and its mask. Income is PII but stays readable.
MASKS = {
    "first_name": mask_name,
    "last_name": mask_name,
    "email": mask_email,
    "phone": mask_phone,
    "date_of_birth": mask_date,
    "address": mask_address,
}
