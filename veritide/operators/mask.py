"""Masking of PII columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritide.contract import KEY, ROW_ID
from veritide.functions.mask import MASKS
from veritide.operators.reshape import long_form

SAMPLE_ROWS = 10


def mask_table(table: DataFrame) -> DataFrame:
    """Every PII column masked; the others, income among them, pass through."""
    return table.withColumns({c: mask(F.col(c)) for c, mask in MASKS.items()})


def masked_sample(table: DataFrame, size: int = SAMPLE_ROWS) -> DataFrame:
    """``row_id, customer_id, column, before, after`` of the first rows by row number."""
    first = table.orderBy(ROW_ID).limit(size)
    rows = [
        [F.col(ROW_ID), F.col(KEY), F.lit(c), F.col(c), mask(F.col(c))]
        for c, mask in MASKS.items()
    ]
    return long_form(first, [ROW_ID, KEY, "column", "before", "after"], rows)
