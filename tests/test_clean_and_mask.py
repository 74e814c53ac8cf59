import pytest
from conftest import AS_OF

from veritide.operators import clean, mask
from veritide.operators.rules import customer_rules

ROWS = [
    ("1", "nora", "quist", "nora@a.org", "(212) 555-0101", "1981-04-05", "10 Long Road, Hull", "41000", "active", "2018-02-03"),
    ("", "owen", "reyes", "owen@b.org", "212-555-0102", "11/30/1992", "20 Long Road", "52000", "unused", "2018-02-03"),
    ("3", "", "stone", "", "212-555-0103", "2001-01-01", "30 Long Road", "", " ", "2018-02-03"),
    ("4", "pia", "", "pia@c.org", "", "", "40 Long Road", "75000", "suspended", ""),
]
# Rows left, invalid rows left, and rows changed per column, found by two engines at each scale.
GOLDEN = {
    "0.001": (148, 56, {"phone": 92, "date_of_birth": 16, "created_date": 8, "first_name": 146, "last_name": 148}),
    "0.01": (1484, 636, {"phone": 951, "date_of_birth": 144, "created_date": 77, "first_name": 1471, "last_name": 1486}),
    "0.1": (14845, 6258, {"phone": 9524, "date_of_birth": 1443, "created_date": 780, "first_name": 14712, "last_name": 14862}),
}


@pytest.fixture
def raw(customers):
    return customers(*ROWS)


def test_clean(raw):
    rows = {r.row_id: r for r in clean.clean(raw, review=True).collect()}
    assert sorted(rows) == [0, 2, 3]
    assert (rows[0].first_name, rows[0].phone, rows[0].review_columns) == ("Nora", "212-555-0101", [])
    assert (rows[2].first_name, rows[2].account_status, rows[2].email) == ("Unknown", "unknown", "")
    assert rows[2].review_columns == ["email", "income"]
    assert rows[3].last_name == "Unknown"
    assert rows[3].review_columns == ["phone", "date_of_birth", "created_date"]


def test_logs(raw):
    log = {(r.action, r.column): r.n for r in clean.missing_log(raw).collect()}
    assert log == {
        ("drop", "customer_id"): 1, ("placeholder", "first_name"): 1, ("placeholder", "last_name"): 1,
        ("placeholder", "account_status"): 1, ("flag", "email"): 1, ("flag", "phone"): 1,
        ("flag", "date_of_birth"): 1, ("flag", "income"): 1, ("flag", "created_date"): 1,
    }
    changes = {r.column: r.n_changed for r in clean.normalization_changes(raw).collect()}
    assert changes == {"phone": 1, "date_of_birth": 1, "created_date": 0, "first_name": 3, "last_name": 3}
    both = clean.cleaning_log(raw)
    assert {r.column: r.n_changed for r in both["normalization"].collect()} == changes
    assert {(r.action, r.column): r.n for r in both["missing_values"].collect()} == log


def test_a_row_counts_for_the_first_column_it_lacks(raw):
    strategy = {"email": "drop", "customer_id": "drop", "first_name": "flag", "phone": "flag"}
    log = {(r.action, r.column): r.n for r in clean.missing_log(raw, strategy).collect()}
    assert log == {("drop", "email"): 1, ("drop", "customer_id"): 1, ("flag", "phone"): 1}
    assert clean.handle_missing(raw, strategy).count() == 2


@pytest.mark.parametrize("sf", GOLDEN)
def test_golden_cleaning(raw_at, sf):
    rows, invalid, changes = GOLDEN[sf]
    raw = raw_at(sf)
    phases, by_check = clean.before_after(raw, clean.clean(raw), customer_rules(AS_OF))
    after = phases.filter("phase = 'after'").first()
    before = phases.filter("phase = 'before'").first()
    assert (after.row_count, after.invalid_row_count) == (rows, invalid)
    assert after.invalid_row_count <= before.invalid_row_count
    assert {r.column: r.n_changed for r in clean.normalization_changes(raw).collect()} == changes
    left = {(r.column, r.check): (r.before_count, r.after_count) for r in by_check.collect()}
    assert left["customer_id", "unique"][0] == left["customer_id", "unique"][1]
    for c in ("customer_id", "first_name", "last_name", "account_status"):
        assert left[c, "required"][1] == 0


def test_mask_table(raw):
    masked = mask.mask_table(clean.clean(raw)).orderBy("row_id").collect()
    assert [r.first_name for r in masked] == ["N***", "U***", "P***"]
    assert [r.email for r in masked] == ["n***@a.org", "", "p***@c.org"]
    assert [r.phone for r in masked] == ["***-***-0101", "***-***-0103", ""]
    assert [r.income for r in masked] == ["41000", "", "75000"]
    assert [r.account_status for r in masked] == ["active", "unknown", "suspended"]


def test_masked_sample(raw):
    sample = mask.masked_sample(raw, 2).collect()
    assert len(sample) == 12
    assert tuple(sample[0]) == (0, "1", "first_name", "nora", "n***")
    assert {r.row_id for r in sample} == {0, 1}
