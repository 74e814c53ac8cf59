import re

import pytest
from conftest import AS_OF, edited
from pyspark.sql import Observation
from pyspark.sql import functions as F

from veritide.operators import keys, validate
from veritide.operators.judge import _entries, judge
from veritide.operators.keys import repeated_rows
from veritide.operators.rules import Rule, customer_rules

RULES = customer_rules(AS_OF)

# Row counts, rows with a failure, and failures per check, found by two engines at each scale.
GOLDEN = {
    "0.001": (150, 70, "2 2 6 2 4 2 2 2 21 3 5 4 20 28 2 4 2 13 1 3 1 9"),
    "0.01": (1500, 791, "16 8 62 15 29 14 14 19 202 25 47 32 178 251 12 23 11 142 10 28 9 86"),
    "0.1": (
        15000,
        7877,
        "155 70 620 149 284 138 132 190 2006 246 466 320 1784 2514 119 222 108 1504 96 268 84 863",
    ),
}
GOLDEN_CHECKS = (
    "customer_id.required customer_id.positive_integer customer_id.unique first_name.required "
    "first_name.valid_name last_name.required last_name.valid_name email.required "
    "email.valid_email phone.required phone.valid_phone date_of_birth.required "
    "date_of_birth.valid_date_format date_of_birth.plausible_age address.required "
    "address.valid_length income.required income.in_range account_status.required "
    "account_status.valid_status created_date.required created_date.valid_date_format"
).split()


def counts(table, rules=RULES):
    by_check = judge(table, rules).by_check.collect()
    return {f"{r.column}.{r.check}": r.failure_count for r in by_check}


def test_there_are_22_rules():
    assert sorted(f"{r.column}.{r.check}" for r in RULES) == sorted(GOLDEN_CHECKS)


def test_valid_table_passes(customers, valid_rows):
    result = judge(customers(*valid_rows), RULES)
    assert result.summary.first().asDict() == {
        "row_count": 3, "invalid_row_count": 0, "invalid_pct": 0.0, "is_valid": True,
    }
    assert result.by_check.count() == 0
    assert result.failures.count() == 0


@pytest.mark.parametrize(
    "cells, failing",
    [
        ({"customer_id": "2"}, {"customer_id.unique": 2}),
        ({"customer_id": "0"}, {"customer_id.positive_integer": 1}),
        ({"customer_id": "1.5"}, {"customer_id.positive_integer": 1}),
        ({"customer_id": " 1e3 "}, {}),
        ({"customer_id": "inf"}, {"customer_id.positive_integer": 1}),
        ({"customer_id": ""}, {"customer_id.required": 1}),
        ({"customer_id": "2.0"}, {}),  # the rule compares text
        ({"first_name": "J0hn"}, {"first_name.valid_name": 1}),
        ({"last_name": " "}, {"last_name.required": 1}),
        ({"last_name": "A"}, {"last_name.valid_name": 1}),
        ({"email": ""}, {"email.required": 1}),
        ({"email": "not-an-email"}, {"email.valid_email": 1}),
        ({"phone": "12345"}, {"phone.valid_phone": 1}),
        ({"phone": "+1 (212) 555-0101"}, {}),
        ({"date_of_birth": "1800-01-01"}, {"date_of_birth.plausible_age": 1}),
        ({"date_of_birth": "2026-01-02"}, {"date_of_birth.plausible_age": 1}),
        (
            {"date_of_birth": "invalid_date"},
            {"date_of_birth.valid_date_format": 1, "date_of_birth.plausible_age": 1},
        ),
        ({"created_date": "invalid_date"}, {"created_date.valid_date_format": 1}),
        ({"created_date": "1600-01-01"}, {"created_date.valid_date_format": 1}),
        ({"address": "Short"}, {"address.valid_length": 1}),
        ({"address": "x" * 201}, {"address.valid_length": 1}),
        ({"income": "-500"}, {"income.in_range": 1}),
        ({"income": "10000000"}, {}),
        ({"income": "10000000.01"}, {"income.in_range": 1}),
        ({"income": "inf"}, {"income.in_range": 1}),
        ({"income": "lots"}, {"income.in_range": 1}),
        ({"account_status": "Active"}, {"account_status.valid_status": 1}),
        ({"account_status": " active"}, {"account_status.valid_status": 1}),
    ],
)
def test_one_fault_fails_its_check(customers, valid_rows, cells, failing):
    assert counts(customers(*edited(valid_rows, **cells))) == failing


def test_failure_case_holds_the_value(customers, valid_rows):
    found = validate.failure_cases(customers(*edited(valid_rows, email="bad")), RULES).collect()
    assert [tuple(r) for r in found] == [(0, "email", "valid_email", "bad")]


def test_blank_keys_are_not_repeated(customers, valid_rows):
    rows = [list(r) for r in valid_rows]
    rows[0][0] = rows[1][0] = ""
    assert counts(customers(*rows)) == {"customer_id.required": 2}


def test_absent_and_wrongly_typed_columns(customers, valid_rows):
    table = customers(*valid_rows).drop("email").withColumn("income", F.lit(1.5))
    result = judge(table, RULES)
    assert {tuple(r) for r in result.failures.collect()} == {
        (None, "email", "column_in_table", "email"),
        (None, "income", "dtype", "double"),
    }
    assert counts(table) == {"email.column_in_table": 1, "income.dtype": 1}
    summary = result.summary.first()
    assert (summary.invalid_row_count, summary.is_valid) == (0, False)


def test_nulls_fail_not_null_only(spark, customers, valid_rows):
    fields = "row_id bigint, " + ", ".join(f"{r.column} string" for r in RULES[:10])
    rows = [(0, *edited(valid_rows, phone=None)[0])]
    assert counts(spark.createDataFrame(rows, fields)) == {"phone.not_null": 1}


def test_own_rules_and_readers(customers, valid_rows):
    rules = [
        Rule("email", "ends_in_org", lambda v: v.endswith(".org")),
        Rule("income", "above", lambda n: n > 100, lambda v: v.try_cast("double")),
        Rule("income", "short", lambda n: n < 6, lambda v: F.length(v)),
    ]
    table = customers(*edited(valid_rows, email="nora@a.com"))
    assert counts(table, rules) == {"email.ends_in_org": 1, "income.above": 1, "income.short": 1}


def test_written_failures_give_the_same_reports(raw_at):
    result = judge(raw_at("0.001"), RULES)
    assert validate.summarize_failures(result.failures, 150).collect() == result.summary.collect()
    assert sorted(validate.count_failures(result.failures).collect()) == sorted(result.by_check.collect())


def test_any_number_of_keys(customers, valid_rows):
    rows = [list(r) for r in valid_rows] + [list(valid_rows[0]), list(valid_rows[1])]
    rows[4][3] = ""  # fails a rule on rows as well as that on the key
    table, rules = customers(*rows, partitions=3), [*RULES, Rule("email", "unique"), Rule("phone", "unique")]
    assert counts(table, rules) == {
        "customer_id.unique": 4, "email.unique": 2, "phone.unique": 4, "email.required": 1
    }
    assert judge(table, rules).summary.first().invalid_row_count == 4
    flagged = {r.row_id: r for r in validate.row_checks(table, rules).collect()}
    assert [flagged[i]["email__unique"] for i in range(5)] == [False, True, True, False, True]
    assert [flagged[i]["customer_id__unique"] for i in range(5)] == [False, False, True, False, False]
    assert validate.row_checks(table, rules).columns[-3:] == ["customer_id__unique", "email__unique", "phone__unique"]
    stored = sorted(tuple(r) for r in judge(table, rules).failures.collect())
    assert stored == sorted(tuple(r) for r in validate.failure_cases(table, rules).collect())


def test_two_keys_travel_in_one_exchange(spark):
    table = spark.range(100).selectExpr("id AS row_id", "cast(id % 7 AS string) AS a", "cast(id AS string) AS b")
    marked = repeated_rows(table, "a", "b")
    plan = marked._sc._jvm.PythonSQLUtils.explainString(marked._jdf.queryExecution(), "simple")
    one = repeated_rows(table, "a")
    of_one = one._sc._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "simple")
    assert plan.count("Exchange hash") == of_one.count("Exchange hash")
    assert marked.count() == 100 and marked.where("column = 'b'").count() == 0


def test_the_rules_are_evaluated_in_one_scan_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").selectExpr(
        "c_custkey AS row_id", "c_name AS first_name", "c_mktsegment AS phone", "cast(c_custkey AS string) AS customer_id"
    ).write.parquet(path)
    table = spark.read.parquet(path)
    rules = [r for r in RULES if r.column in table.columns]
    verdicts = validate.row_verdicts(table, rules)
    _, unique = validate.usable_rules(table, rules)
    seen = Observation()
    entries = _entries(table, verdicts, unique, seen)
    plan = entries._sc._jvm.PythonSQLUtils.explainString(entries._jdf.queryExecution(), "simple")
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    assert not re.search("Exchange|HashAggregate|Join|Python", plan)
    assert plan.count("~") + plan.count("NOT ") < 60  # a verdict is made once and then read
    judged = judge(table, rules, str(tmp_path / "out"))
    read = {f.rsplit("/", 3)[-3] if "kind=" in f else f.rsplit("/", 2)[-2] for f in judged.failures.inputFiles()}
    assert read <= {"entries", "repeated"}


def test_without_a_key_there_is_no_join(customers, valid_rows):
    rules = [r for r in RULES if r.check != "unique"]
    rows = [list(r) for r in valid_rows]
    rows[1][0] = "1"
    assert counts(customers(*rows), rules) == {}
    assert validate.row_checks(customers(*rows), rules).columns == ["row_id", *[r.name for r in rules]]


def test_empty_table(customers, valid_rows):
    summary = judge(customers(*valid_rows).filter("false"), RULES).summary.first()
    assert tuple(summary) == (0, 0, 0.0, True)


@pytest.mark.parametrize("sf", GOLDEN)
def test_golden_counts(raw_at, sf):
    rows, invalid, expected = GOLDEN[sf]
    judged = judge(raw_at(sf), RULES)
    summary = judged.summary.first()
    assert (summary.row_count, summary.invalid_row_count) == (rows, invalid)
    found = {f"{r.column}.{r.check}": r.failure_count for r in judged.failed_checks.collect()}
    assert found == dict(zip(GOLDEN_CHECKS, map(int, expected.split())))


def test_reports_agree_with_each_other(raw_at):
    raw = raw_at("0.001")
    result = judge(raw, RULES)
    failures = [tuple(r) for r in result.failures.collect()]
    assert len(failures) == sum(r.failure_count for r in result.by_check.collect())
    assert len({f[0] for f in failures}) == result.summary.first().invalid_row_count
    for check in result.by_check.collect():
        rows = sorted(f[0] for f in failures if f[1:3] == (check.column, check.check))
        assert check.sample_row_ids == rows[:5]
    flagged = validate.row_checks(raw, RULES).collect()
    assert sum(not all(v for k, v in r.asDict().items() if k != "row_id") for r in flagged) == 70


def test_partitions_do_not_matter(raw_at):
    raw = raw_at("0.001")
    one, many = (
        sorted(tuple(r) for r in validate.failure_cases(raw.repartition(n), RULES).collect())
        for n in (1, 8)
    )
    assert one == many


def test_names_of_any_kind(customers, valid_rows):
    table = customers(*edited(valid_rows, email="nora@a.com")).withColumnRenamed("phone", "home.phone")
    table = table.withColumns({"place": F.lit("x"), "key": F.lit("y"), "n": F.lit(1)})
    rules = [
        Rule("email", "company__mail", lambda v: v.endswith(".nowhere")),
        Rule("home.phone", "short", lambda v: F.length(v) < 3),
        Rule("customer_id", "unique"),
    ]
    result = judge(table, rules)
    found = {(r.column, r.check): r.sample_row_ids for r in result.by_check.collect()}
    assert set(found) == {("email", "company__mail"), ("home.phone", "short")} and all(found.values())
    assert validate.row_checks(table, rules).columns[1:] == [r.name for r in rules]
    plans = [
        re.sub(r"#\d+L?|(?<=_common_expr_)\d+", "", f._jdf.queryExecution().optimizedPlan().toString())
        for f in (validate.failure_cases(table, [*RULES[1:3], *rules]) for _ in range(2))
    ]
    assert plans[0] == plans[1]


def test_every_hot_key_is_spread(spark):
    """Each of two keys holds half of the rows, or each of 3,000 a few; no task gets a whole hot key."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        for n_keys in (2, 3000):
            table = spark.range(40_000).selectExpr("id AS row_id", f"concat('k', id % {n_keys}) AS k")
            tasks = repeated_rows(table, "k").groupBy(F.spark_partition_id().alias("task")).count()
            rows = [r["count"] for r in tasks.collect()]
            assert sum(rows) == 40_000 and max(rows) < 0.4 * 40_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_hot_keys_give_the_same_rows(spark, monkeypatch, parts):
    """One key holds a third of the rows, others repeat or not; any number of parts gives the same result."""
    monkeypatch.setattr(keys, "PARTS_PER_PARTITION", parts)
    texts = ["hot" if i % 3 == 0 else f"k{i // 4}" if i % 7 else f"u{i}" for i in range(600)]
    texts += ["", " ", ""]
    table = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, k string").repartition(5)
    found = {(r.row_id, r.key_text) for r in repeated_rows(table, "k").collect()}
    assert found == {(i, t) for i, t in enumerate(texts) if t.strip() and texts.count(t) > 1}


def test_plan_stays_in_the_jvm_and_limits_samples_early(raw_at):
    result = judge(raw_at("0.001"), RULES)
    for frame in (result.summary, result.by_check, result.failures):
        plan = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")
        assert not re.search("Python|Cartesian|NestedLoop", plan)
    plan = frame._sc._jvm.PythonSQLUtils.explainString(
        validate.failure_samples(result.failures)._jdf.queryExecution(), "simple"
    )
    assert "WindowGroupLimit" in plan and "Partial" in plan
