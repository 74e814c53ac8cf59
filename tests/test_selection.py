import random

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from veritide.operators.selection import at_most, kth_smallest
from veritide.sources.faults import generate_customers


@pytest.mark.parametrize("k", [1, 40, 399, 400])
def test_kth_smallest_is_that_of_a_sort(spark, k):
    draw = random.Random(5)
    rows = [(draw.choice([0, 7, 1 << 30, draw.randrange(1 << 31)]), i) for i in draw.sample(range(1 << 20), 400)]
    table = spark.createDataFrame(rows, "draw bigint, number bigint").repartition(5)
    bound = kth_smallest(table, k, {"draw": 31, "number": 20})
    assert tuple(bound) == sorted(rows)[k - 1]
    assert table.where(at_most(["draw", "number"], bound)).count() == k


def test_more_than_there_are_is_refused(spark):
    table = spark.range(3)
    with pytest.raises(ValueError, match="fewer rows"):
        kth_smallest(table, 4, {"id": 4})
    with pytest.raises(ValueError, match="counts from 1"):
        kth_smallest(table, 0, {"id": 4})


@pytest.mark.parametrize(("n", "rate", "repeats"), [(2, 0.0, 1), (60, 0.1, 6), (200, 1.0, 200), (3, 0.7, 2)])
def test_exactly_so_many_rows_take_an_id(spark, n, rate, repeats):
    made = generate_customers(spark, n, error_rate=0, duplicate_rate=rate, as_of=AS_OF, exact_duplicates=True)
    own = F.col("row_id").cast("string")
    assert made.where((F.col("customer_id") != own) & ((F.col("row_id") != 16) | (F.col("customer_id") != ""))).count() == repeats


def test_few_rows_are_warned_of(spark):
    with pytest.warns(UserWarning, match="first 5 of 25"):
        generate_customers(spark, 5, as_of=AS_OF)
