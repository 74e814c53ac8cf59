"""PII: how much of it is populated, whether it looks right, how many identities are complete."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide import contract
from veritide.functions.numbers import percent
from veritide.functions.text import is_present, matches_email, matches_phone
from veritide.operators.reshape import hold_row, long_form

PATTERNS = {"email": matches_email, "phone": matches_phone}


def categories_in(table: DataFrame) -> dict[str, list[str]]:
    """The PII columns of each category that the table has."""
    return {
        category: [c for c in columns if c in table.columns]
        for category, (_, columns) in contract.PII_CATEGORIES.items()
    }


def pii_measures(table: DataFrame) -> DataFrame:
    """Every count of the PII report in one row, by one pass over the PII columns."""
    measures: dict[str, Column] = {}
    for columns in categories_in(table).values():
        for c in columns:
            measures[f"populated__{c}"] = F.count_if(is_present(F.col(c)))
    for c, matches in PATTERNS.items():
        if c in table.columns:
            value = F.col(c)
            measures[f"matching__{c}"] = F.count_if(is_present(value) & matches(value))
    if set(contract.IDENTITY_COLUMNS) <= set(table.columns):
        whole = reduce(and_, [is_present(F.col(c)) for c in contract.IDENTITY_COLUMNS])
        measures["whole_identities"] = F.count_if(whole)
    aggregates = [m.alias(name) for name, m in measures.items()]
    return table.agg(F.count("*").alias("row_count"), *aggregates)


def pii_occurrences(table: DataFrame) -> DataFrame:
    """``category, risk_level, column, populated_count, category_total`` per PII column."""
    return _occurrences(pii_measures(table), categories_in(table))


def pii_patterns(table: DataFrame) -> DataFrame:
    """``column, populated_count, matching_count, non_matching_count`` for emails and phones."""
    return _patterns(pii_measures(table))


def breach_exposure(table: DataFrame) -> DataFrame:
    """One row: records, those with every identity column populated, and their percent."""
    return _exposure(pii_measures(table))


def pii_report(table: DataFrame) -> dict[str, DataFrame]:
    """Every section by name, from one pass whose single row is held on the driver."""
    taken = hold_row(pii_measures(table))
    return {
        "pii_occurrences": _occurrences(taken, categories_in(table)),
        "pii_patterns": _patterns(taken),
        "breach_exposure": _exposure(taken),
    }


def _occurrences(measured: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    rows = []
    for category, columns in categories.items():
        counts = [F.col(f"populated__{c}") for c in columns]
        total = reduce(lambda a, b: a + b, counts, F.lit(0).cast("bigint"))
        risk, _ = contract.PII_CATEGORIES[category]
        rows += [
            [F.lit(category), F.lit(risk), F.lit(c), count, total]
            for c, count in zip(columns, counts)
        ]
    names = ["category", "risk_level", "column", "populated_count", "category_total"]
    return long_form(measured, names, rows)


def _patterns(measured: DataFrame) -> DataFrame:
    rows = []
    for c in PATTERNS:
        if f"matching__{c}" in measured.columns:
            populated, matching = F.col(f"populated__{c}"), F.col(f"matching__{c}")
            rows.append([F.lit(c), populated, matching, populated - matching])
    names = ["column", "populated_count", "matching_count", "non_matching_count"]
    return long_form(measured, names, rows)


def _exposure(measured: DataFrame) -> DataFrame:
    whole = F.col("whole_identities")
    return measured.select(
        F.col("row_count").alias("total_records"),
        whole.alias("full_profile_count"),
        percent(whole, F.col("row_count")).alias("full_profile_pct"),
    )
