"""Generated customers with seeded faults, every cell a function of the row number.

There is no state and no ``rand()``: a row comes out the same in any partition and on any retry, and
the table can be as large as the range of row numbers.
"""

from __future__ import annotations

import datetime as dt
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritide import contract
from veritide.contract import COLUMNS, KEY, ROW_ID
from veritide.functions.dates import resolve_as_of
from veritide.operators.selection import at_most, kth_smallest

FIRST_NAMES = [
    "Ada", "Bruno", "Carla", "Dmitri", "Elena", "Farid", "Greta", "Hugo", "Ines", "Jonas",
]
LAST_NAMES = [
    "Abbott", "Bauer", "Castro", "Dahl", "Evans", "Fischer", "Grant", "Haddad", "Ito", "Jensen",
]
MAIL_DOMAINS = ["mail.example.com", "post.example.org", "inbox.example.net"]
STREETS = ["Harbour Street", "Mill Lane", "Station Road", "Garden Avenue", "Castle Hill"]
TOWNS = ["Northfield", "Westbrook", "Easton", "Southport"]

# The faults in the order in which the first rows get one each.
FAULTS = [
    "invalid_name",
    "invalid_email",
    "invalid_phone",
    "phone_format_variation",
    "invalid_date_literal_dob",
    "age_over_150",
    "age_negative",
    "non_iso_date_format_dob",
    "non_iso_date_format_created",
    "address_too_short",
    "address_too_long",
    "negative_income",
    "income_over_max",
    "invalid_account_status",
    "created_before_dob",
    *[f"missing_{column}" for column in COLUMNS],
]
# The faulty texts.
INVALID_NAMES = ["J0hn", "M@rie", "A", "12345", "O'Brien!!", "X" * 60]
INVALID_EMAILS = [
    "not-an-email", "missing.domain@", "user@nodot", "@no-local-part.com", "user domain.com",
]
INVALID_PHONES = ["12345", "phone-number", "000-00-0000", "abcdefghij"]
INVALID_STATUSES = ["Active", "ACTIVE", "pending", "closed", "N/A", ""]
SHORT_ADDRESSES = ["1 A St", "Short", "12 Elm"]
OTHER_DATE_FORMATS = ["MM/dd/yyyy", "dd-MMM-yyyy", "dd/MM/yyyy"]

# The defaults of the generator.
ROWS, SEED = 1000, 42
RATES = {"error_rate": 0.15, "format_variation_rate": 0.3, "duplicate_rate": 0.02}

# Draws are integers below this prime; their products stay within 64 bits.
PRIME = 2147483647
# What a draw is for. The place in the list makes the draws of a row independent of one another.
PURPOSES = [
    "first_name", "last_name", "domain", "area", "exchange", "line", "birth", "created", "house",
    "street", "town", "income", "status", "has_fault", "fault", "varies", "duplicate", "source",
    "name_column", "sample", "days", "layout", "second_layout", "place",
]


def draw_constants(purpose: str, seed: int) -> tuple[int, int]:
    number = PURPOSES.index(purpose) + 1
    return (48271 * number + 69621 * seed) % PRIME, (16807 * number * number + 40692 * seed) % PRIME


def with_draws(
    table: DataFrame, row: str, purposes: list[str], seed: int, prefix: str = "draw_"
) -> DataFrame:
    """Add a whole number below the prime per purpose, scattered by squaring twice.

    It takes only integer arithmetic, so another SQL engine can draw the same numbers. Each squaring
    is a projection of its own, as its operand is used twice.
    """
    constants = {f"{prefix}{p}": draw_constants(p, seed) for p in purposes}
    number = F.col(row) % PRIME
    return (
        table.withColumns({c: (number * f + o) % PRIME for c, (f, o) in constants.items()})
        .withColumns({c: (F.col(c) * F.col(c) + f) % PRIME for c, (f, _) in constants.items()})
        .withColumns({c: (F.col(c) * F.col(c) + o) % PRIME for c, (_, o) in constants.items()})
    )


def generate_customers(
    spark: SparkSession,
    n_rows: int,
    seed: int = SEED,
    error_rate: float = RATES["error_rate"],
    format_variation_rate: float = RATES["format_variation_rate"],
    duplicate_rate: float = RATES["duplicate_rate"],
    as_of: dt.date | Column | None = None,
    shuffled: bool = False,
    exact_duplicates: bool = False,
) -> DataFrame:
    """``n_rows`` customers as text with a row number; see ``customers_for``."""
    if n_rows <= 0:
        raise ValueError("n_rows must be positive")
    if n_rows < len(FAULTS):
        warnings.warn(f"{n_rows} rows hold the first {n_rows} of {len(FAULTS)} kinds of faults only", stacklevel=2)
    rows = spark.range(1, n_rows + 1).select(F.col("id").alias(ROW_ID))
    table = customers_for(
        rows, n_rows, seed, error_rate, format_variation_rate, duplicate_rate, as_of, exact_duplicates
    )
    if not shuffled:
        return table
    return with_draws(table, ROW_ID, ["place"], seed).orderBy("draw_place").drop("draw_place")


def customers_for(
    rows: DataFrame,
    n_rows: int,
    seed: int = SEED,
    error_rate: float = RATES["error_rate"],
    format_variation_rate: float = RATES["format_variation_rate"],
    duplicate_rate: float = RATES["duplicate_rate"],
    as_of: dt.date | Column | None = None,
    exact_duplicates: bool = False,
) -> DataFrame:
    """A customer per row number of ``rows``, which run from 1 to ``n_rows``.

    The first rows have one fault each, in order. Later rows have a random fault at ``error_rate``
    and, apart from that, another phone layout at ``format_variation_rate``. At ``duplicate_rate`` a
    row takes over the id of another one; the last row always does. With ``exact_duplicates`` that rate
    doesn't hold in expectation only: ``n_rows`` times it, rounded and at least 1, rows take over the id
    of another row. Those are found by a few passes over the row numbers.
    """
    for name, rate in (
        ("error_rate", error_rate),
        ("format_variation_rate", format_variation_rate),
        ("duplicate_rate", duplicate_rate),
    ):
        if not 0 <= rate <= 1:
            raise ValueError(f"{name} must be between 0 and 1")
    as_of = resolve_as_of(as_of)
    numbered = with_draws(rows.select(ROW_ID), ROW_ID, PURPOSES[:-1], seed).withColumns(
        {
            "fault": _fault_number(F.col(ROW_ID), "draw_", error_rate),
            "varies": (F.col(ROW_ID) > len(FAULTS)) & _happens("varies", format_variation_rate),
        }
    )
    clean = clean_columns(numbered, as_of)
    layout = other_layout(clean, "layout")
    faulty = layout.withColumns(_faulty_columns(as_of))
    varied = other_layout(faulty, "second_layout").withColumn(
        "phone", F.when(F.col("varies"), F.col("other_phone")).otherwise(F.col("phone"))
    )
    own = rows if exact_duplicates else None
    taken = with_source_ids(varied, n_rows, error_rate, duplicate_rate, seed, own)
    return taken.select(ROW_ID, *COLUMNS)


def fault_code(name: str) -> int:
    return FAULTS.index(name) + 1


def _fault_number(row: Column, prefix: str, error_rate: float) -> Column:
    """Which fault a row has, counted from 1; 0 for none."""
    return (
        F.when(row <= len(FAULTS), row)
        .when(
            F.col(f"{prefix}has_fault") < int(error_rate * PRIME),
            F.col(f"{prefix}fault") % len(FAULTS) + 1,
        )
        .otherwise(F.lit(0))
    )


def _happens(purpose: str, rate: float) -> Column:
    return F.col(f"draw_{purpose}") < int(rate * PRIME)


def _between(low: int, high: int, purpose: str) -> Column:
    return (F.lit(low) + F.col(f"draw_{purpose}") % (high - low + 1)).cast("int")


def _pick(values: list[str], purpose: str) -> Column:
    place = (F.col(f"draw_{purpose}") % len(values) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), place)


def _money(low: int, high: int, purpose: str) -> Column:
    cents = F.lit(low * 100) + F.col(f"draw_{purpose}") % ((high - low) * 100 + 1)
    return (cents / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)").cast("string")


def clean_columns(numbered: DataFrame, as_of: Column) -> DataFrame:
    """Valid cells in every column: 18 to 90 years old, and a customer no sooner than at 18."""
    adult = F.date_add(F.col("birth"), 18 * 365)
    since = F.col("draw_created") % (F.datediff(as_of, adult) + 1)
    parts = numbered.withColumns(
        {
            "birth": F.date_sub(as_of, _between(18 * 366, 90 * 365, "birth")),
            "first_name": _pick(FIRST_NAMES, "first_name"),
            "last_name": _pick(LAST_NAMES, "last_name"),
            "area": _between(200, 999, "area").cast("string"),
            "exchange": _between(200, 999, "exchange").cast("string"),
            "line": _between(1000, 9999, "line").cast("string"),
        }
    )
    email = [F.lower("first_name"), F.lit("."), F.lower("last_name"), F.lit("@")]
    house = _between(1, 999, "house").cast("string")
    street = F.concat(_pick(STREETS, "street"), F.lit(","))
    return parts.withColumns(
        {
            "created": F.date_add(adult, since.cast("int")),
            KEY: F.col(ROW_ID).cast("string"),
            "email": F.concat(*email, _pick(MAIL_DOMAINS, "domain")),
            "phone": F.concat_ws("-", "area", "exchange", "line"),
            "date_of_birth": F.col("birth").cast("string"),
            "address": F.concat_ws(" ", house, street, _pick(TOWNS, "town")),
            "income": _money(20_000, 250_000, "income"),
            "account_status": _pick(contract.STATUSES, "status"),
        }
    ).withColumn("created_date", F.col("created").cast("string"))


def other_layout(table: DataFrame, purpose: str) -> DataFrame:
    """Add ``other_phone``: one of five layouts of the phone's digits, of new ones without any."""
    digits, new = F.col("digits"), F.concat("area", "exchange", "line")
    found = table.withColumn("digits", F.regexp_replace("phone", "[^0-9]", "")).withColumn(
        "digits", F.when(digits != "", digits).otherwise(new)
    )
    area, exchange = F.substring(digits, 1, 3), F.substring(digits, 4, 3)
    line = F.substring(digits, 7, 4)
    layouts = [
        ["(", area, ") ", exchange, "-", line],
        [area, ".", exchange, ".", line],
        [area, exchange, line],
        ["+1-", area, "-", exchange, "-", line],
        ["+1 ", area, " ", exchange, " ", line],
    ]
    texts = [F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]) for parts in layouts]
    place = F.col(f"draw_{purpose}") % len(layouts)
    chosen = reduce(
        lambda rest, i: F.when(place == i, texts[i]).otherwise(rest), range(4), texts[-1]
    )
    return found.withColumn("other_phone", chosen)


def _other_format(day: str) -> Column:
    place = F.col("draw_sample") % len(OTHER_DATE_FORMATS)
    texts = [F.date_format(day, form) for form in OTHER_DATE_FORMATS]
    return F.coalesce(*[F.when(place == i, text) for i, text in enumerate(texts)])


def _faulty_columns(as_of: Column) -> dict[str, Column]:
    """Every column with its faults, of which a row has one at most."""
    into_first = F.col("draw_name_column") % 2 == 0
    name = _pick(INVALID_NAMES, "sample")
    days = _between(30, 3650, "days")
    long_ago = F.year(as_of) - _between(151, 200, "days")
    spoiled = {
        "first_name": {"invalid_name": F.when(into_first, name).otherwise(F.col("first_name"))},
        "last_name": {"invalid_name": F.when(into_first, F.col("last_name")).otherwise(name)},
        "email": {"invalid_email": _pick(INVALID_EMAILS, "sample")},
        "phone": {
            "invalid_phone": _pick(INVALID_PHONES, "sample"),
            "phone_format_variation": F.col("other_phone"),
        },
        "date_of_birth": {
            "invalid_date_literal_dob": F.lit(contract.INVALID_DATE),
            "age_over_150": F.concat(long_ago.cast("string"), F.lit("-01-15")),
            "age_negative": F.date_add(as_of, days).cast("string"),
            "non_iso_date_format_dob": _other_format("birth"),
        },
        "address": {
            "address_too_short": _pick(SHORT_ADDRESSES, "sample"),
            "address_too_long": F.repeat(F.concat("address", F.lit(" ")), F.lit(10)),
        },
        "income": {
            "negative_income": F.concat(F.lit("-"), _money(1_000, 50_000, "sample")),
            "income_over_max": _money(10_000_001, 20_000_000, "sample"),
        },
        "account_status": {"invalid_account_status": _pick(INVALID_STATUSES, "sample")},
        "created_date": {
            "non_iso_date_format_created": _other_format("created"),
            "created_before_dob": F.date_sub("birth", days).cast("string"),
        },
    }
    return {
        c: reduce(
            lambda cell, fault: F.when(F.col("fault") == fault_code(fault[0]), fault[1]).otherwise(
                cell
            ),
            {**spoiled.get(c, {}), f"missing_{c}": F.lit("")}.items(),
            F.col(c),
        )
        for c in COLUMNS
    }


def with_source_ids(
    table: DataFrame, n_rows: int, error_rate: float, duplicate_rate: float, seed: int, rows: DataFrame | None = None
) -> DataFrame:
    """Overwrite ids by those of other rows, which need no lookup as they follow from the number.

    The source is never the last row, so the last row always takes an id used before. Given the row
    numbers in ``rows``, exactly as many rows as the rate says take an id, and none its own.
    """
    if n_rows < 2:
        return table
    source = F.col("draw_source") % (n_rows - 1) + 1
    if rows is None:
        taken = _happens("duplicate", duplicate_rate)
    else:
        taken = _exactly(rows, n_rows, max(1, round(n_rows * duplicate_rate)) - 1, seed)
        # A row before the last leaves itself out; with two rows there is no other before the last.
        among = F.col("draw_source") % max(1, n_rows - 2) + 1
        among = among + (among >= F.col(ROW_ID)).cast("int")
        source = F.when(F.col(ROW_ID) == n_rows, source).otherwise(among)
    numbered = table.withColumn("source", source)
    sources = with_draws(numbered, "source", ["has_fault", "fault"], seed, "source_")
    lacks_id = _fault_number(F.col("source"), "source_", error_rate) == fault_code(f"missing_{KEY}")
    source_id = F.when(lacks_id, F.lit("")).otherwise(F.col("source").cast("string"))
    return sources.withColumn(KEY, F.when(taken | (F.col(ROW_ID) == n_rows), source_id).otherwise(F.col(KEY)))


def _exactly(rows: DataFrame, n_rows: int, wanted: int, seed: int) -> Column:
    """Whether a row is one of the ``wanted`` rows before the last with the smallest draws."""
    if wanted == 0:
        return F.lit(False)
    drawn = with_draws(rows.select(ROW_ID).where(F.col(ROW_ID) < n_rows), ROW_ID, ["duplicate"], seed)
    keys = {"draw_duplicate": PRIME.bit_length(), ROW_ID: n_rows.bit_length()}
    return (F.col(ROW_ID) < n_rows) & at_most(list(keys), kth_smallest(drawn, wanted, keys))
