import pytest

from veritide.operators.profile_history import ERROR, ProfileHistory


def test_days_merge_and_none_counts_twice(spark, tmp_path):
    history = ProfileHistory(spark, str(tmp_path / "kept"))
    assert history.merged().count() == 0
    for day in range(4):
        # Days overlap by half; a seventh of the cells is missing, and the last day has a column more.
        table = spark.range(day * 5000, day * 5000 + 10000).selectExpr("id", "nullif(id % 7, 0) AS rest", "id AS more")
        assert history.add(f"d{day}", table if day == 3 else table.drop("more"))
    assert not history.add("d1", spark.range(3))
    found = {r["column"]: r for r in history.merged().collect()}
    assert (found["id"].row_count, found["id"].missing_count, found["more"].row_count) == (40000, 0, 10000)
    assert abs(found["id"].distinct_estimate - 25000) <= 25000 * ERROR
    assert found["rest"].distinct_estimate == 6 and found["rest"].missing_pct == pytest.approx(14.29, abs=0.01)
    some = {r["column"]: r for r in history.merged("d1", "d2").collect()}
    assert some["id"].row_count == 20000 and abs(some["id"].distinct_estimate - 15000) <= 15000 * ERROR


def test_empty_and_missing(spark, tmp_path):
    history = ProfileHistory(spark, str(tmp_path))
    history.add("none", spark.range(0))
    assert history.merged().first().asDict() == {
        "column": "id", "row_count": 0, "missing_count": 0, "missing_pct": history.merged().first().missing_pct, "distinct_estimate": 0
    }
    history.add("nan", spark.sql("SELECT CAST('NaN' AS double) AS id UNION ALL SELECT 1.0 UNION ALL SELECT NULL"))
    found = history.merged().first()
    assert (found.row_count, found.missing_count, found.distinct_estimate) == (3, 2, 1)
    with pytest.raises(ValueError, match="letters"):
        history.add("a/b", spark.range(1))
