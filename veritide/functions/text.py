"""Text expressions: presence, patterns, title case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritide import contract

# (?U) makes \s Unicode-wide; the four separators are blank too, though not white space in Unicode.
NON_BLANK = r"(?U)[^\s\x1c-\x1f]"
# Letters with case. Java's Lu and Ll alone would leave out the likes of the roman numerals.
CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"


def is_present(value: Column) -> Column:
    """True where something is left after stripping Unicode white space; null stays null.

    Text that starts with a printable ASCII character is decided by two byte comparisons, so the
    pattern only sees the few values that start otherwise.
    """
    starts_printable = (value >= "!") & (value < "\x7f")
    return starts_printable | value.rlike(NON_BLANK)


def unless_blank(value: Column, changed: Column) -> Column:
    """``changed`` where there is a value; blanks are kept as they are."""
    return F.when(is_present(value), changed).otherwise(value)


def matches_email(value: Column) -> Column:
    return value.rlike("(?d)" + contract.EMAIL_PATTERN)


def matches_phone(value: Column) -> Column:
    return value.rlike("(?dU)" + contract.PHONE_PATTERN)


def matches_canonical_phone(value: Column) -> Column:
    return value.rlike("(?dU)" + contract.CANONICAL_PHONE_PATTERN)


def matches_name(value: Column) -> Column:
    return value.rlike("(?d)" + contract.NAME_PATTERN)


def matches_iso_shape(value: Column) -> Column:
    return value.rlike("(?dU)" + contract.ISO_DATE_PATTERN)


def title_case(value: Column) -> Column:
    """Capitalise every run of letters: ``o'brien`` becomes ``O'Brien``, ``j0hn`` ``J0Hn``.

    ``initcap`` starts a word only after a space. So a space goes in after each character without
    case, and comes out again afterwards. A single plain word, as most names are, needs neither.
    """
    spaced = F.regexp_replace(value, f"([^{CASED}])", "$1 ")
    respaced = F.regexp_replace(F.initcap(spaced), f"([^{CASED}]) ", "$1")
    return F.when(value.rlike(r"^[A-Za-z]+\z"), F.initcap(value)).otherwise(respaced)
