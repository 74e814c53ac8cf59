"""Cleaning: bring values into form, then drop, fill or flag what is missing."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide import contract
from veritide.functions.normalize import NORMALIZERS
from veritide.functions.text import is_present
from veritide.operators.reshape import hold_row, long_form
from veritide.operators.judge import judge
from veritide.operators.rules import Rule

REVIEW = "review_columns"


def normalize_columns(table: DataFrame) -> DataFrame:
    return table.withColumns({c: bring(F.col(c)) for c, bring in NORMALIZERS.items()})


def normalization_changes(table: DataFrame) -> DataFrame:
    """``column, n_changed`` over all rows of the raw table, dropped later or not."""
    changed = table.agg(*[_changes(c).alias(c) for c in NORMALIZERS])
    return long_form(changed, ["column", "n_changed"], [[F.lit(c), F.col(c)] for c in NORMALIZERS])


def _changes(column: str) -> Column:
    return F.count_if(NORMALIZERS[column](F.col(column)) != F.col(column))


def _columns_to(strategy: dict[str, str], action: str) -> list[str]:
    return [c for c, chosen in strategy.items() if chosen == action]


def _is_kept(strategy: dict[str, str]) -> Column:
    required = [is_present(F.col(c)) for c in _columns_to(strategy, "drop")]
    return reduce(and_, required, F.lit(True))


def handle_missing(
    table: DataFrame,
    strategy: dict[str, str] = contract.MISSING_STRATEGY,
    placeholders: dict[str, str] = contract.PLACEHOLDERS,
    review: bool = False,
) -> DataFrame:
    """Drop rows, fill placeholders, and leave the rest blank.

    ``review`` adds the array of the columns that were left blank. Row numbers stay those of the
    source.
    """
    filled = {
        c: F.when(is_present(F.col(c)), F.col(c)).otherwise(F.lit(placeholders[c]))
        for c in _columns_to(strategy, "placeholder")
    }
    kept = table.filter(_is_kept(strategy)).withColumns(filled)
    if not review:
        return kept
    blanks = [F.when(~is_present(F.col(c)), F.lit(c)) for c in _columns_to(strategy, "flag")]
    return kept.withColumn(REVIEW, F.array_compact(F.array(*blanks)))


def missing_log(
    table: DataFrame, strategy: dict[str, str] = contract.MISSING_STRATEGY
) -> DataFrame:
    """``action, column, n`` where n is not 0: dropped rows, then fills and flags of kept rows.

    A row that lacks several required columns counts for the first of them.
    """
    counts = missing_counts(strategy)
    logged = table.agg(*[count.alias(name) for name, count in counts.items()])
    return log_of(logged, strategy)


def missing_counts(strategy: dict[str, str] = contract.MISSING_STRATEGY) -> dict[str, Column]:
    counts, remaining = {}, F.lit(True)
    for c in _columns_to(strategy, "drop"):
        counts[f"drop__{c}"] = F.count_if(remaining & ~is_present(F.col(c)))
        remaining = remaining & is_present(F.col(c))
    for action in ("placeholder", "flag"):
        for c in _columns_to(strategy, action):
            counts[f"{action}__{c}"] = F.count_if(_is_kept(strategy) & ~is_present(F.col(c)))
    return counts


def log_of(logged: DataFrame, strategy: dict[str, str] = contract.MISSING_STRATEGY) -> DataFrame:
    rows = [
        [*[F.lit(part) for part in name.split("__", 1)], F.col(name)]
        for name in missing_counts(strategy)
    ]
    return long_form(logged, ["action", "column", "n"], rows).filter("n > 0")


def clean(table: DataFrame, review: bool = False) -> DataFrame:
    return handle_missing(normalize_columns(table), review=review)


def cleaning_log(table: DataFrame) -> dict[str, DataFrame]:
    """Both logs of cleaning a raw table, from one pass whose single row is held on the driver.

    Bringing a value into form never makes it blank, so the missing counts need no second pass over
    the result.
    """
    taken = hold_row(
        table.agg(
            *[_changes(c).alias(c) for c in NORMALIZERS],
            *[count.alias(name) for name, count in missing_counts().items()],
        )
    )
    changes = [[F.lit(c), F.col(c)] for c in NORMALIZERS]
    return {
        "normalization": long_form(taken, ["column", "n_changed"], changes),
        "missing_values": log_of(taken),
    }


def before_after(
    raw: DataFrame, cleaned: DataFrame, rules: list[Rule]
) -> tuple[DataFrame, DataFrame]:
    """The validation summary of both tables by phase, and the failures per check side by side; each is judged once."""
    before, after = judge(raw, rules), judge(cleaned, rules)
    return compare_summaries(before.summary, after.summary), compare_checks(before.failed_checks, after.failed_checks)


def compare_summaries(before: DataFrame, after: DataFrame) -> DataFrame:
    first = before.select(F.lit("before").alias("phase"), "*")
    return first.unionByName(after.select(F.lit("after").alias("phase"), "*"))


def compare_checks(before: DataFrame, after: DataFrame) -> DataFrame:
    """``column, check, before_count, after_count`` of the checks that fail before or after."""
    keys = ["column", "check"]
    counts = [
        checks.select(*keys, F.col("failure_count").alias(name))
        for name, checks in (("before_count", before), ("after_count", after))
    ]
    both = counts[0].join(counts[1], keys, "full")
    return both.fillna(0, ["before_count", "after_count"])
