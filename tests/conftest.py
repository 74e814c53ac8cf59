import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from veritide import contract  # noqa: E402
from veritide.session import local_session  # noqa: E402
from veritide.sources.messy_customers import messy_customers  # noqa: E402

TESTDATA = "/root/testdata"
AS_OF = dt.date(2026, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def customers(spark):
    """Make a customer table of text from rows in the contract's column order."""

    def make(*rows, partitions=1):
        numbered = [(i, *row) for i, row in enumerate(rows)]
        fields = ", ".join(f"{c} string not null" for c in contract.COLUMNS)
        frame = spark.createDataFrame(numbered, f"row_id bigint not null, {fields}")
        return frame.repartition(partitions) if partitions > 1 else frame

    return make


@pytest.fixture
def valid_rows():
    return [
        ["1", "Nora", "Quist", "nora@a.org", "212-555-0101", "1981-04-05", "10 Long Road, Hull", "41000", "active", "2018-02-03"],
        ["2", "Owen", "Reyes", "owen@b.org", "212-555-0102", "1992-11-30", "20 Long Road, Hull", "52000.5", "inactive", "2019-12-31"],
        ["3", "Pia", "Stone", "pia@c.org", "212-555-0103", "2001-01-01", "30 Long Road, Hull", "0", "suspended", "2020-06-15"],
    ]


@pytest.fixture(scope="session")
def raw_at(spark):
    """The messy customers at a scale."""

    def make(sf):
        return messy_customers(spark, spark.read.parquet(f"{TESTDATA}/sf{sf}/customer.parquet"))

    return make


def edited(rows, **cells):
    """A copy of the rows with cells of row 0 replaced."""
    copy = [list(r) for r in rows]
    for column, value in cells.items():
        copy[0][contract.COLUMNS.index(column)] = value
    return copy
