"""One-row aggregates and the metric frames made from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_form(one_row: DataFrame, names: list[str], rows: Iterable[list[Column]]) -> DataFrame:
    """A row with many columns as many rows: ``rows`` holds the expressions of each."""
    entries = [F.struct(*[cell.alias(n) for n, cell in zip(names, row)]) for row in rows]
    return one_row.select(F.inline(F.array(*entries)))


def hold_row(one_row: DataFrame) -> DataFrame:
    """Evaluate a one-row frame now and keep the row, so that what is cut from it costs nothing."""
    return one_row.sparkSession.createDataFrame(one_row.toArrow(), one_row.schema)
