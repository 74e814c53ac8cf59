"""Data-quality profile: completeness, types, formats, uniqueness, invalid values, domains."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritide import contract
from veritide.contract import KEY, ROW_ID
from veritide.functions.dates import age_in_years, in_timestamp_range, read_iso_date, resolve_as_of
from veritide.functions.numbers import is_boolean_text, is_integer, is_number, percent, to_number
from veritide.functions.text import matches_canonical_phone, matches_iso_shape
from veritide.operators.reshape import hold_row, long_form

DATE_COLUMNS = [c for c, expected in contract.EXPECTED_TYPES.items() if expected.startswith("date")]
PHONE_SAMPLE = 5
KEY_SAMPLE = 10
INVALID_READS = ["number__income", f"number__{KEY}", "day__date_of_birth"]
NUMERIC_TYPES = ["int64", "float64", "bool"]


def data_columns(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c != ROW_ID]


def is_missing(table: DataFrame, column: str) -> Column:
    """Null, or not a number in a floating-point column."""
    value = F.col(column)
    if isinstance(table.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


# --- Measures: expressions of one global aggregate, by name -------------------------------------


def reads(table: DataFrame, columns: list[str]) -> dict[str, Column]:
    """Numbers and dates read from the text columns, which the measures share."""
    made = {}
    for c in columns:
        if not _is_text(table, c):
            made[f"number__{c}"] = F.col(c).try_cast("double")
            continue
        made[f"number__{c}"] = to_number(F.col(c))
        if c in DATE_COLUMNS:
            made[f"day__{c}"] = read_iso_date(F.col(c))
    return made


def _is_text(table: DataFrame, column: str) -> bool:
    return isinstance(table.schema[column].dataType, T.StringType)


def missing_measures(table: DataFrame, columns: list[str]) -> dict[str, Column]:
    return {f"missing__{c}": F.count_if(is_missing(table, c)) for c in columns}


def type_measures(table: DataFrame, columns: list[str]) -> dict[str, Column]:
    """Whether all values that are there read as integer, number, boolean or ISO date."""
    measures = {}
    for c in columns:
        if not _is_text(table, c):
            continue
        value, number = F.col(c), F.col(f"number__{c}")
        readable = {
            "int": is_integer(value, number),
            "num": is_number(value, number),
            "bool": is_boolean_text(value),
        }
        if c in DATE_COLUMNS:
            readable["date"] = F.coalesce(in_timestamp_range(F.col(f"day__{c}")), F.lit(False))
        for kind, is_read in readable.items():
            all_read = F.bool_and(F.when(value.isNotNull(), is_read))
            measures[f"{kind}__{c}"] = F.coalesce(all_read, F.lit(True))
    return measures


def format_measures() -> dict[str, Column]:
    phone = F.col("phone").cast("string")
    measures = {"non_canonical__phone": F.count_if(~matches_canonical_phone(phone))}
    for c in DATE_COLUMNS:
        odd = (F.col(c) != contract.INVALID_DATE) & ~matches_iso_shape(F.col(c).cast("string"))
        measures[f"non_iso__{c}"] = F.count_if(odd)
    return measures


def invalid_measures(as_of: dt.date | Column | None) -> dict[str, Column]:
    income, key, birth = (F.col(c) for c in INVALID_READS)
    counted = F.col("income").isNotNull() & is_number(F.col("income").cast("string"), income)
    age = F.when(in_timestamp_range(birth), age_in_years(birth, resolve_as_of(as_of)))
    return {
        "negative__income": F.count_if(counted & (income < contract.INCOME_RANGE[0])),
        "over_max__income": F.count_if(
            counted & ~F.isnan(income) & (income > contract.INCOME_RANGE[1])
        ),
        **{
            f"invalid_date_literal__{c}": F.count_if(F.col(c) == contract.INVALID_DATE)
            for c in DATE_COLUMNS
        },
        "age_over_max__date_of_birth": F.count_if(age > contract.AGE_RANGE[1]),
        "age_negative__date_of_birth": F.count_if(age < contract.AGE_RANGE[0]),
        f"non_positive__{KEY}": F.count_if(key <= 0),
    }


def measure(
    table: DataFrame, measures: dict[str, Column], inputs: dict[str, Column] | None = None
) -> DataFrame:
    """The row count and the measures in one row, by a single pass without a shuffle of rows."""
    prepared = table.select("*", *[made.alias(name) for name, made in (inputs or {}).items()])
    aggregates = [m.alias(name) for name, m in measures.items()]
    return prepared.agg(F.count("*").alias("row_count"), *aggregates)


def quality_measures(table: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    """Every measure of the customer profile in one pass."""
    expected = [c for c in contract.COLUMNS if c in table.columns]
    measures = {
        **missing_measures(table, data_columns(table)),
        **type_measures(table, expected),
        **format_measures(),
        **invalid_measures(as_of),
    }
    return measure(table, measures, reads(table, expected))


# --- Reports on a table -------------------------------------------------------------------------


def completeness(table: DataFrame) -> DataFrame:
    """``column, missing_count, missing_pct`` of any table."""
    columns = data_columns(table)
    return completeness_of(measure(table, missing_measures(table, columns)), columns)


def type_profile(table: DataFrame) -> DataFrame:
    """``column, expected_type, actual_dtype, matches_expected``, with the dtype a reader infers."""
    columns = [c for c in contract.COLUMNS if c in table.columns]
    measures = {**missing_measures(table, columns), **type_measures(table, columns)}
    return types_of(measure(table, measures, reads(table, columns)), table.schema)


def format_issues(table: DataFrame) -> DataFrame:
    """``issue, column, row_count`` of values that are there but not in the standard format."""
    return issues_of(measure(table, format_measures()))


def invalid_values(table: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    """``issue, column, row_count`` of values out of bounds; ages are taken at ``as_of``."""
    inputs = reads(table, ["income", KEY, "date_of_birth"])
    return issues_of(measure(table, invalid_measures(as_of), inputs))


def completeness_of(measured: DataFrame, columns: list[str]) -> DataFrame:
    rows = [
        [F.lit(c), F.col(f"missing__{c}"), percent(F.col(f"missing__{c}"), F.col("row_count"))]
        for c in columns
    ]
    return long_form(measured, ["column", "missing_count", "missing_pct"], rows)


def types_of(measured: DataFrame, schema: T.StructType) -> DataFrame:
    rows = []
    for f in schema:
        if f.name not in contract.EXPECTED_TYPES:
            continue
        expected = contract.EXPECTED_TYPES[f.name]
        dtype = _dtype(f)
        if expected in ("integer", "numeric"):
            matches = dtype.isin(NUMERIC_TYPES)
        elif f.name in DATE_COLUMNS and isinstance(f.dataType, T.StringType):
            matches = F.col(f"date__{f.name}")
        elif f.name in DATE_COLUMNS:
            matches = F.lit(isinstance(f.dataType, (T.DateType, T.TimestampType)))
        else:
            matches = dtype == "object"
        rows.append([F.lit(f.name), F.lit(expected), dtype, matches])
    names = ["column", "expected_type", "actual_dtype", "matches_expected"]
    return long_form(measured, names, rows)


def _dtype(field: T.StructField) -> Column:
    """Name of the type a dataframe reader infers: integers with gaps turn into floats."""
    c = field.name
    gaps = F.col(f"missing__{c}") > 0
    if isinstance(field.dataType, T.StringType):
        return (
            F.when(F.col("row_count") == 0, "object")
            .when(F.col(f"missing__{c}") == F.col("row_count"), "float64")
            .when(~gaps & F.col(f"int__{c}"), "int64")
            .when(F.col(f"num__{c}"), "float64")
            .when(~gaps & F.col(f"bool__{c}"), "bool")
            .otherwise("object")
        )
    if isinstance(field.dataType, T.IntegralType):
        return F.when(gaps, "float64").otherwise("int64")
    if isinstance(field.dataType, (T.FractionalType, T.DecimalType)):
        return F.lit("float64")
    if isinstance(field.dataType, T.BooleanType):
        return F.when(gaps, "object").otherwise("bool")
    if isinstance(field.dataType, (T.DateType, T.TimestampType)):
        return F.lit("datetime64[ns]")
    return F.lit("object")


def issues_of(measured: DataFrame) -> DataFrame:
    named = [c for c in measured.columns if c != "row_count"]
    rows = [[*[F.lit(part) for part in name.split("__", 1)], F.col(name)] for name in named]
    return long_form(measured, ["issue", "column", "row_count"], rows)


def noncanonical_phones(table: DataFrame, size: int = PHONE_SAMPLE) -> DataFrame:
    """The first phones, by row number, that are not in the canonical format."""
    odd = table.filter(~matches_canonical_phone(F.col("phone")))
    return odd.select(ROW_ID, "phone").orderBy(ROW_ID).limit(size)


# --- Uniqueness ---------------------------------------------------------------------------------


def key_counts(table: DataFrame, key: str = KEY, as_number: bool | None = None) -> DataFrame:
    """``value, text, row_count`` per key; the rows without a key are one more group, of null text.

    Keys compare by the inferred type: as numbers (``7`` and ``7.0`` are one) if the whole column
    reads as numbers, else as text. That takes a look at the column unless ``as_number`` says it.
    The combine before the shuffle makes a hot key harmless.
    """
    present = F.when(~is_missing(table, key), F.col(key))
    keys = table.select(present.alias("value"), present.cast("string").alias("text"))
    if _is_text(table, key):
        number = to_number(F.col("text"))
        if as_number is None:
            unread = F.col("text").isNotNull() & number.isNull()
            compare_numbers = keys.agg(F.count_if(unread) == 0).scalar()
        else:
            compare_numbers = F.lit(as_number)
        keys = keys.select(
            F.struct(
                F.when(compare_numbers, number).alias("number"),
                F.when(~compare_numbers, F.col("text")).alias("text"),
            ).alias("value"),
            "text",
        )
    return keys.groupBy("value").agg(F.min("text").alias("text"), F.count("*").alias("row_count"))


def uniqueness(table: DataFrame, key: str = KEY, as_number: bool | None = None) -> DataFrame:
    """One row: ``total_rows, unique_keys, duplicate_rows``, every row of a repeated key counted."""
    repeated = F.col("text").isNotNull() & (F.col("row_count") > 1)
    return key_counts(table, key, as_number).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.count("text").alias("unique_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("row_count"))), F.lit(0)).alias("duplicate_rows"),
    )


def repeated_keys(table: DataFrame, key: str = KEY, as_number: bool | None = None) -> DataFrame:
    """``value, text, row_count`` of the keys that more than one row has."""
    return key_counts(table, key, as_number).filter("text IS NOT NULL AND row_count > 1")


def repeated_key_sample(
    table: DataFrame, key: str = KEY, size: int = KEY_SAMPLE, as_number: bool | None = None
) -> DataFrame:
    """The smallest repeated keys, with the number of their rows."""
    smallest = repeated_keys(table, key, as_number).orderBy("value").limit(size)
    return smallest.select(F.col("text").alias(key), "row_count")


# --- Domains ------------------------------------------------------------------------------------


def value_counts(table: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """``column, row_count, is_valid`` per value; a missing value counts as ``nan`` and invalid."""
    value = F.col(column)
    valid = F.coalesce(value.isin(domain), F.lit(False))
    counts = table.groupBy(column).agg(F.count("*").alias("row_count"))
    return counts.select(
        F.coalesce(value.cast("string"), F.lit("nan")).alias(column),
        "row_count",
        valid.alias("is_valid"),
    )


def status_counts(table: DataFrame) -> DataFrame:
    counts = value_counts(table, "account_status", contract.STATUSES)
    return counts.orderBy(F.desc("row_count"), "account_status")


def invalid_statuses(table: DataFrame) -> DataFrame:
    counts = value_counts(table, "account_status", contract.STATUSES)
    return counts.filter(~F.col("is_valid")).select("account_status", "row_count")


def invalid_status_rows(table: DataFrame) -> DataFrame:
    """One row: how many rows hold a status out of the domain."""
    return invalid_statuses(table).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("invalid_row_count")
    )


# --- Whole profile ------------------------------------------------------------------------------


def quality_report(
    table: DataFrame, as_of: dt.date | Column | None = None
) -> dict[str, DataFrame]:
    """Every section of the profile by name.

    The measures are taken at once and held in one row on the driver; the sections cut from it cost
    no further pass.
    """
    taken = hold_row(quality_measures(table, as_of))
    as_number = taken.first()[f"num__{KEY}"] if _is_text(table, KEY) else None
    return {
        "completeness": completeness_of(taken, data_columns(table)),
        "types": types_of(taken, table.schema),
        "format_issues": issues_of(taken.select(*format_measures())),
        "noncanonical_phones": noncanonical_phones(table),
        "uniqueness": uniqueness(table, as_number=as_number),
        "repeated_key_sample": repeated_key_sample(table, as_number=as_number),
        "invalid_values": issues_of(taken.select(*invalid_measures(as_of))),
        "status_counts": status_counts(table),
        "invalid_statuses": invalid_statuses(table),
    }
