import random
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from veritide.operators import renumber
from veritide.operators.renumber import dense_numbers


@pytest.mark.parametrize("rows", [0, 1, 7, 5000])
def test_numbers_are_dense_and_in_order(spark, rows):
    ids = spark.range(rows).select((F.col("id") * 97 - 300 + F.col("id") % 5).alias("row_id"), F.lit("x").alias("a"))
    table = ids.repartition(6).where("row_id % 3 <> 1").unionByName(ids.limit(0))
    found = sorted(tuple(r) for r in dense_numbers(table).collect())
    assert [r[2] for r in found] == list(range(table.count()))


def test_no_task_holds_all_rows(spark):
    numbered = dense_numbers(spark.range(20_000).select(F.col("id").alias("row_id")))
    plan = numbered._sc._jvm.PythonSQLUtils.explainString(numbered._jdf.queryExecution(), "simple")
    assert plan.count("SinglePartition") == 1  # the counts of the buckets
    assert numbered.columns == ["row_id", "position"]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 800])
def test_a_bucket_is_how_many_bounds_are_below(spark, n):
    draw = random.Random(n)
    bounds = sorted({draw.randrange(-2000, 2000) for _ in range(n)})
    values = [*range(-2002, 2003, 3), *bounds, -(1 << 63), (1 << 63) - 1]
    table = spark.createDataFrame([(v,) for v in [*values, None]], "v bigint")
    found = table.select("v", renumber.bucket_of(F.col("v"), bounds).alias("bucket")).collect()
    assert all(r.bucket == (0 if r.v is None else bisect_left(bounds, r.v)) for r in found)


def test_no_row_is_compared_with_every_bound(spark):
    plan = dense_numbers(spark.range(20_000).select(F.col("id").alias("row_id")))
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert "filter(" not in text


def test_numbers_that_many_passes_read_are_made_once(spark, tmp_path, monkeypatch):
    spark.range(300).select((F.col("id") * 7 - 90).cast("int").alias("c_custkey")).write.parquet(str(tmp_path / "customer.parquet"))
    plans, whole = [], __spark_entry__.customers_for

    def noted(rows, *args, **options):
        plans.append(rows._sc._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "simple"))
        return whole(rows, *args, **options)

    monkeypatch.setattr(__spark_entry__, "customers_for", noted)
    found = __spark_entry__.queries()["generated_exact_repeats"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in found] == [(0.02, 300, 6), (0.1, 300, 30), (0.3, 300, 90)]
    assert len(plans) == 3 and not any("Exchange" in p or "Window" in p for p in plans)
