import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from veritide import contract
from veritide.operators.judge import judge
from veritide.operators.rules import customer_rules
from veritide.sources.faults import FAULTS, generate_customers


@pytest.fixture(scope="module")
def table(spark):
    return generate_customers(spark, 500, seed=7, as_of=AS_OF).cache()


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_shape(table):
    assert table.columns == ["row_id", *contract.COLUMNS]
    assert table.count() == 500


def test_seed_decides(spark, table):
    again = generate_customers(spark, 500, seed=7, as_of=AS_OF)
    assert rows(again.repartition(7)) == rows(table)
    assert rows(generate_customers(spark, 500, seed=8, as_of=AS_OF)) != rows(table)


def test_every_kind_of_fault_is_there(table):
    assert table.groupBy("customer_id").count().filter("count > 1").count() > 0
    missing = table.agg(*[F.count_if(F.col(c) == "").alias(c) for c in contract.COLUMNS]).first()
    assert all(missing.asDict().values())
    income = F.col("income").try_cast("double")
    found = table.agg(
        F.count_if(F.col("date_of_birth") == "invalid_date").alias("literal"),
        F.count_if(~F.col("account_status").isin(contract.STATUSES)).alias("status"),
        F.count_if(income < 0).alias("negative"),
        F.count_if(income > 10_000_000).alias("over_max"),
        F.count_if(F.col("phone").rlike(r"^\(|\.|^\+1")).alias("layout"),
        F.count_if(F.length("address") > 200).alias("long"),
        F.count_if(F.col("created_date") < F.col("date_of_birth")).alias("before_birth"),
    ).first()
    assert all(found.asDict().values()), found


def test_first_rows_have_a_fault_each_and_the_rest_can_be_clean(spark):
    clean = generate_customers(spark, 2000, error_rate=0, format_variation_rate=0, duplicate_rate=0, as_of=AS_OF)
    failures = judge(clean, customer_rules(AS_OF)).failures
    # Only the first rows, the last row and the row whose id that one took can fail.
    last = clean.filter("row_id = 2000").first().customer_id
    late = failures.filter(f"row_id > {len(FAULTS)}").collect()
    assert {str(r.row_id) for r in late} <= {"2000", last}
    assert failures.filter(f"row_id <= {len(FAULTS)}").select("row_id").distinct().count() >= 20


def test_rates_hold(spark):
    table = generate_customers(spark, 20000, error_rate=0.5, format_variation_rate=0.0, duplicate_rate=0.1, as_of=AS_OF)
    own = table.filter(F.col("customer_id") != F.col("row_id").cast("string")).count()
    assert 0.10 < own / 20000 < 0.14  # a tenth by duplication, and a 50th of the faults blank the id
    names = table.filter(F.col("first_name") == "").count()
    assert 0.01 < names / 20000 < 0.03


@pytest.mark.parametrize("bad", [{"n_rows": 0}, {"n_rows": 5, "error_rate": 1.5}, {"n_rows": 5, "duplicate_rate": -1}])
def test_bad_arguments(spark, bad):
    with pytest.raises(ValueError):
        generate_customers(spark, **bad)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_small_tables(spark, n):
    assert generate_customers(spark, n, as_of=AS_OF).count() == n


def test_shuffled_has_the_same_rows(spark):
    plain, shuffled = (generate_customers(spark, 200, as_of=AS_OF, shuffled=s).collect() for s in (False, True))
    assert sorted(plain) == sorted(shuffled)
    assert [r.row_id for r in shuffled] != sorted(r.row_id for r in shuffled)
