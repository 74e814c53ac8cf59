import pytest

from veritide.operators import pii

ROWS = [
    ("1", "Nora", "Quist", "nora@a.org", "212-555-0101", "1981-04-05", "10 Long Road, Hull", "41000", "active", "2018-02-03"),
    ("2", "", "Reyes", "not-an-email", "212-555-0102", "1992-11-30", "20 Long Road", "52000", "active", "2018-02-03"),
    ("3", "Pia", " ", "pia@c.org", "garbage", "", "30 Long Road", "", "active", "2018-02-03"),
]


@pytest.fixture
def table(customers):
    return customers(*ROWS)


def test_occurrences(table):
    found = {r.column: r for r in pii.pii_occurrences(table).collect()}
    assert {c: r.populated_count for c, r in found.items()} == {
        "first_name": 2, "last_name": 2, "email": 3, "phone": 3, "date_of_birth": 2, "address": 3, "income": 2,
    }
    assert found["email"].category_total == 6
    assert (found["address"].category, found["address"].risk_level) == ("sensitive_personal", "High")


def test_patterns(table):
    assert {tuple(r) for r in pii.pii_patterns(table).collect()} == {("email", 3, 2, 1), ("phone", 3, 2, 1)}


def test_exposure(table):
    assert tuple(pii.breach_exposure(table).first()) == (3, 1, 33.33)
    assert tuple(pii.breach_exposure(table.filter("false")).first()) == (0, 0, 0.0)


def test_absent_columns_are_left_out(table):
    found = pii.pii_occurrences(table.drop("income", "email")).collect()
    assert [r.column for r in found] == ["first_name", "last_name", "phone", "date_of_birth", "address"]


def test_report_is_the_sections(table):
    report = pii.pii_report(table)
    assert report["pii_occurrences"].collect() == pii.pii_occurrences(table).collect()
    assert report["pii_patterns"].collect() == pii.pii_patterns(table).collect()
    assert report["breach_exposure"].collect() == pii.breach_exposure(table).collect()
