"""Columns whose names hold dots or back-ticks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(name: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")
