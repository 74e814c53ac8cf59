"""Expressions against literals and against what Python and pandas say of the same text."""

import random
import re
from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from veritide import contract
from veritide.functions import dates, mask, normalize, numbers, text

BLANKS = [
    "", " ", "\t", "\u00a0", "\u0085", "\u3000", "\x1c", " \n\u2003 ", "\u200b", "a", " a ", "!",
    "~", "\x7f", "\u00e9",
]
PHONES = [
    "(555) 123-4567", "555.234.5678", "5553456789", "+1-555-456-7890", "+1 555 456 7890", "12345",
    "555-123-4567", "call 5551234567", "15551234567", "25551234567", "555-123-456", "phone-number",
    "５５５-123-4567", "555 123 4567", "555-123-4567\n", "555-123-4567\r", "+15551234567", "12", "",
]
EMAILS = [
    "john@x.com", "not-an-email", "a@b", "@x.com", "a@b.c", "a@b.co", "o'brien@x.com", "a b@x.com",
    "a@b@c.com", "x@y.com\n", "x@y.com\r", "A.B+c_%-@d-e.f.museum", "",
]
NAMES = ["John", "O'Brien", "Mary-Jane", "van dyke", "J0hn", "A", " Jo", "X" * 60, "Élan", "Jo  An", "Jo\n", ""]
DAYS = [
    "1985-03-05", "1985-3-5", "1985-03- 5", " 1985-03-05", "1985-03-05 ", "1985-02-30", "1985-13-01",
    "85-03-05", "1677-09-21", "1677-09-22", "2262-04-11", "2262-04-12", "1985-03-05T00:00", "19850305",
    "03/15/1985", "15-Mar-1985", "invalid_date", "1985-00-10", "1984-02-29", "",
]
OTHER_DAYS = [
    "03/15/1985", "3/5/1985", "25/12/1999", "12/25/1999", "15-Mar-1985", "15-MAR-1985", "15-March-1985",
    "31/11/1999", "31/04/1985", " 03/15/1985", "1600-01-01", "2300-01-01", "03/04/1985", "29-Feb-1985",
    "29-Feb-1984", "32-Jan-1990", "1-jan-1990", "1990-1-1", "invalid_date", "00/00/0000", "",
]
NUMBERS = [
    "12", " 12 ", "1_000", "1e3", "1E5", "+5", "-5", "--5", "5.", ".5", ".", "5d", "5f", "0x10", "NaN",
    "nan", "inf", "-Infinity", "1,000", "", "1 2", "\t5\n", "1e", "abc", "True", "1e400", "1e-400",
]


def apply(spark, expression, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = frame.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


def test_presence_is_what_strip_leaves(spark):
    assert apply(spark, text.is_present, BLANKS) == [v.strip() != "" for v in BLANKS]
    assert apply(spark, text.is_present, [None]) == [None]


@pytest.mark.parametrize(
    "matches, pattern, values",
    [
        (text.matches_phone, contract.PHONE_PATTERN, PHONES),
        (text.matches_canonical_phone, contract.CANONICAL_PHONE_PATTERN, PHONES),
        (text.matches_email, contract.EMAIL_PATTERN, EMAILS),
        (text.matches_name, contract.NAME_PATTERN, NAMES),
        (text.matches_iso_shape, contract.ISO_DATE_PATTERN, DAYS),
    ],
)
def test_patterns_match_what_python_matches(spark, matches, pattern, values):
    assert apply(spark, matches, values) == [re.match(pattern, v) is not None for v in values]


def test_title_case_is_that_of_python(spark):
    rnd = random.Random(3)
    letters = "abcXYZ 0'-.éÀßжЖ\t "
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9))) for _ in range(500)]
    values = ["john", "MARY", "o'brien", "mary-jane", "J0hn", "McDonald", "van  dyke", "ǆep", "$1", "a\\b", *made]
    assert apply(spark, text.title_case, values) == [v.title() for v in values]


def test_numbers_read_as_pandas_reads_them(spark):
    expected = pd.to_numeric(pd.Series(NUMBERS), errors="coerce")
    frame = spark.createDataFrame(list(enumerate(NUMBERS)), "i int, v string")
    read = frame.withColumn("n", numbers.to_number(F.col("v")))
    counted = F.when(numbers.is_number(F.col("v"), F.col("n")), F.col("n"))
    rows = read.select("i", counted.alias("n")).orderBy("i").collect()
    assert [r.n for r in rows] == [None if pd.isna(x) else x for x in expected]


def test_integers(spark):
    def is_integer(value):
        return F.coalesce(numbers.is_integer(value, numbers.to_number(value)), F.lit(False))

    values = ["1", " -7 ", "1.0", "1e3", "abc", "9223372036854775807", "9223372036854775808"]
    assert apply(spark, is_integer, values) == [True, True, False, False, False, True, False]


def test_iso_dates_read_as_pandas_reads_them(spark):
    def read(value):
        day = dates.read_iso_date(value)
        return F.when(dates.in_timestamp_range(day), day)

    expected = pd.to_datetime(pd.Series(DAYS), format="%Y-%m-%d", errors="coerce")
    assert apply(spark, read, DAYS) == [None if pd.isna(x) else x.date() for x in expected]


def test_dates_normalise_as_strptime_reads_them(spark):
    def expected(value):
        for form in ("%Y-%m-%d", "%m/%d/%Y", "%d-%b-%Y", "%d/%m/%Y"):
            try:
                return datetime.strptime(value, form).strftime("%Y-%m-%d")
            except ValueError:
                continue
        return value

    values = DAYS + OTHER_DAYS
    assert apply(spark, normalize.normalize_date, values) == [expected(v) for v in values]


def test_age_counts_whole_days(spark):
    frame = spark.sql("SELECT DATE '1876-01-01' AS old, DATE '2026-01-02' AS unborn")
    as_of = F.lit("2026-01-01").cast("date")
    row = frame.select(
        dates.age_in_years(F.col("old"), as_of).alias("old"),
        dates.age_in_years(F.col("unborn"), as_of).alias("unborn"),
    ).first()
    assert (row.old, row.unborn) == ((date(2026, 1, 1) - date(1876, 1, 1)).days / 365.25, -1 / 365.25)


def test_phone_normalises(spark):
    pairs = {
        "(555) 123-4567": "555-123-4567", "555.234.5678": "555-234-5678",
        "5553456789": "555-345-6789", "+1-555-456-7890": "555-456-7890", "": "", "12345": "12345",
        "not-a-phone": "not-a-phone", "call 5551234567": "555-123-4567", "  ": "  ",
        "25551234567": "25551234567", "555-123-4567\n": "555-123-4567",
    }
    assert apply(spark, normalize.normalize_phone, list(pairs)) == list(pairs.values())


def test_name_normalises(spark):
    pairs = {"john": "John", "MARY": "Mary", "o'brien": "O'Brien", "": "", "\u3000": "\u3000"}
    assert apply(spark, normalize.normalize_name, list(pairs)) == list(pairs.values())


@pytest.mark.parametrize(
    "masks, pairs",
    [
        (mask.mask_name, {"John": "J***", "": "", " Jo": " ***", "  ": "  "}),
        (
            mask.mask_email,
            {"john.doe@gmail.com": "j***@gmail.com", "not-an-email": "***", "": "", "a@b@c": "a***@b@c", "@x": "***"},
        ),
        (
            mask.mask_phone,
            {"555-123-4567": "***-***-4567", "(555) 123-4567": "***4567", "12": "***", "": "", "12345": "***2345"},
        ),
        (mask.mask_address, {"1 Any Street": "[MASKED ADDRESS]", "": "", " ": " "}),
        (
            mask.mask_date,
            {"1985-03-15": "1985-**-**", "invalid_date": "****-**-**", "": "", "1985-99-99": "1985-**-**"},
        ),
    ],
)
def test_masks(spark, masks, pairs):
    assert apply(spark, masks, list(pairs)) == list(pairs.values())
