import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from veritide import contract
from veritide.operators import profile
from veritide.sources.tables import inferred_view

TEXTS = [
    ("7", "Nora", "Quist", "nora@a.org", "212-555-0101", "1981-04-05", "10 Long Road, Hull", "41000", "active", "2018-02-03"),
    ("8", "Owen", "Reyes", "bad", "(212) 555-0102", "invalid_date", "20 Long Road, Hull", "-1", "Active", "2019-12-31"),
    ("8", "Owen", "Reyes", "o@b.org", "212-555-0103", "1850-01-01", "NULL", "15000000", "inactive", "02/01/2020"),
    ("", "Pia", "Stone", "p@c.org", "2125550104", "2001-01-01", "30 Long Road, Hull", "0", "N/A", "2020-06-15"),
]


def by(frame, *key):
    return {tuple(r[k] for k in key): r for r in frame.collect()}


@pytest.fixture(params=["text", "typed"])
def seen(request, spark):
    """The same table as text and with numeric columns, missing values as null."""
    fields = ", ".join(f"{c} string" for c in contract.COLUMNS)
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(TEXTS)], f"row_id bigint, {fields}")
    table = inferred_view(table)
    if request.param == "typed":
        table = table.withColumns(
            {"customer_id": F.col("customer_id").cast("bigint"), "income": F.col("income").cast("double")}
        )
    return table


def test_completeness(seen):
    found = by(profile.completeness(seen), "column")
    assert {c[0]: r.missing_count for c, r in found.items() if r.missing_count} == {
        "customer_id": 1, "address": 1, "account_status": 1,
    }
    assert found[("account_status",)].missing_pct == 25.0


def test_types(seen):
    found = by(profile.type_profile(seen), "column")
    assert {c[0]: r.actual_dtype for c, r in found.items() if r.actual_dtype != "object"} == {
        "customer_id": "float64",
        "income": "int64" if dict(seen.dtypes)["income"] == "string" else "float64",
    }
    assert [c for (c,), r in found.items() if not r.matches_expected] == ["date_of_birth", "created_date"]


def test_formats(seen):
    found = by(profile.format_issues(seen), "issue", "column")
    assert {k: r.row_count for k, r in found.items()} == {
        ("non_canonical", "phone"): 2, ("non_iso", "date_of_birth"): 0, ("non_iso", "created_date"): 1,
    }
    phones = profile.noncanonical_phones(seen).collect()
    assert [tuple(r) for r in phones] == [(1, "(212) 555-0102"), (3, "2125550104")]


def test_uniqueness(seen):
    assert tuple(profile.uniqueness(seen).first()) == (4, 2, 2)
    assert [tuple(r) for r in profile.repeated_key_sample(seen).collect()] == [("8", 2)]


def test_invalid_values(seen):
    found = by(profile.invalid_values(seen, AS_OF), "issue", "column")
    assert {k: r.row_count for k, r in found.items()} == {
        ("negative", "income"): 1, ("over_max", "income"): 1,
        ("invalid_date_literal", "date_of_birth"): 1, ("invalid_date_literal", "created_date"): 0,
        ("age_over_max", "date_of_birth"): 1, ("age_negative", "date_of_birth"): 0,
        ("non_positive", "customer_id"): 0,
    }


def test_statuses(seen):
    assert {tuple(r) for r in profile.invalid_statuses(seen).collect()} == {("Active", 1), ("nan", 1)}
    assert profile.invalid_status_rows(seen).first()[0] == 2
    assert profile.status_counts(seen).filter("is_valid").count() == 2


def test_report_is_the_sections(seen):
    report = profile.quality_report(seen, AS_OF)
    for name, section in {
        "completeness": profile.completeness(seen), "types": profile.type_profile(seen),
        "format_issues": profile.format_issues(seen), "uniqueness": profile.uniqueness(seen),
        "invalid_values": profile.invalid_values(seen, AS_OF),
    }.items():
        assert report[name].collect() == section.collect(), name


@pytest.mark.parametrize(
    "values, dtype",
    [
        (["1", "2"], "int64"),
        (["1", None], "float64"),
        (["1", "2.5"], "float64"),
        (["1", "inf"], "float64"),
        ([None, None], "float64"),
        (["True", "false"], "bool"),
        (["True", None], "object"),
        (["1", "x"], "object"),
        (["5d", "1"], "object"),
        ([], "object"),
    ],
)
def test_inferred_type_names(spark, values, dtype):
    table = spark.createDataFrame([(v,) for v in values], "customer_id string")
    assert profile.type_profile(table).first().actual_dtype == dtype


def test_keys_compare_as_numbers_only_if_all_are(spark):
    def unique(*texts):
        table = spark.createDataFrame([(t,) for t in texts], "customer_id string")
        return tuple(profile.uniqueness(table).first())

    assert unique("7", "7.0", "8", None) == (4, 2, 2)
    assert unique("7", "7.0", "x", "x") == (4, 3, 2)
    assert unique() == (0, 0, 0)


def test_missing_tokens(spark):
    table = spark.createDataFrame([(t,) for t in ["NA", "n/a", "", " ", "na", "None"]], "address string")
    assert profile.completeness(inferred_view(table)).first().missing_count == 4


def test_report_reads_what_it_needs_only(spark, tmp_path):
    fields = ", ".join(f"{c} string" for c in contract.COLUMNS)
    spark.createDataFrame(TEXTS, fields).write.parquet(str(tmp_path / "t"))
    seen = inferred_view(spark.read.parquet(str(tmp_path / "t")))
    plan = profile.uniqueness(seen)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<customer_id:string>" in plan
