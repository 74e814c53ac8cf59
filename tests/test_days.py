"""Files and keys that come day by day."""

import re

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from veritide import contract
from veritide.operators.key_history import KeyHistory
from veritide.operators.rules import customer_rules
from veritide.sources.records import MALFORMED
from veritide.streaming import daily

HEADER = ",".join(contract.COLUMNS)
GOOD = "1,Nora,Quist,nora@a.org,212-555-0101,1981-04-05,\"10 Long\nRoad, Hull\",41000,active,2018-02-03"


def keyed(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


def test_keys_of_earlier_days_count(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path), buckets=4)
    assert history.repeated().count() == 0
    assert history.add("mon", keyed(spark, "a", "b", "b", "", None, " "), "k")
    assert [tuple(r) for r in history.repeated().collect()] == [("b", 2)]
    assert history.add("tue", keyed(spark, "a", "c", "b"), "k")
    assert not history.add("tue", keyed(spark, "a", "c", "b"), "k")
    assert sorted(tuple(r) for r in history.repeated().collect()) == [("a", 2), ("b", 3)]
    again = KeyHistory(spark, str(tmp_path), buckets=4)
    assert sorted(tuple(r) for r in again.counts().collect()) == [("a", 2), ("b", 3), ("c", 1)]
    assert sorted(tuple(r) for r in again.manifest().collect()) == [(1, "mon", 2), (2, "tue", 3)]


def test_the_stored_side_is_not_shuffled(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path), buckets=4)
    history.add("mon", spark.range(500).select(F.col("id").cast("string").alias("k")), "k")
    merged = history.merged(keyed(spark, "1", "x"), "k")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = merged._sc._jvm.PythonSQLUtils.explainString(history.merged(keyed(spark, "1", "x"), "k")._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    stored = plan[plan.index("SortMergeJoin") :]
    left = stored[: stored.index("FileScan")]
    assert "Bucketed: true" in plan and "Exchange" not in left
    assert plan.count("Exchange") == 1  # the day's counts


def test_a_merge_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    history = KeyHistory(spark, str(tmp_path), buckets=4)
    history.add("mon", keyed(spark, "a", "a"), "k")
    bad = keyed(spark, "a").withColumn("k", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        history.add("tue", bad, "k")
    assert [tuple(r) for r in history.counts().collect()] == [("a", 2)]
    assert history.add("tue", keyed(spark, "a", "b"), "k")
    assert sorted(tuple(r) for r in history.counts().collect()) == [("a", 3), ("b", 1)]


def test_a_bad_file_stops_no_run(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def run():
        daily.validate_new_files(spark, str(source), str(tmp_path), customer_rules(AS_OF)).awaitTermination()
        return daily.judged_rows(spark, str(tmp_path))

    (source / "1.csv").write_text(f"{HEADER}\n{GOOD}\n{GOOD.replace('nora@a.org', 'nora')}\n")
    assert {r.verdict: r.failed_checks for r in run().collect()} == {"accepted": [], "quarantined": ["email__valid_email"]}
    (source / "2.csv").write_text("x,y\n1,2\n")
    (source / "3.csv").write_text(f"{HEADER}\n{GOOD},more\n\"" + "open\n" * 5)
    (source / "4.csv").write_bytes(b"\xff\xfe\x00\n\x01")
    found = run()
    assert found.where("verdict = 'accepted'").count() == 1
    assert found.where(F.col("file").endswith("2.csv")).first()[MALFORMED] == "1,2"
    reordered = ",".join(reversed(contract.COLUMNS))
    cells = reversed(GOOD.replace('"10 Long\nRoad, Hull"', "10 Long Road Hull").split(","))
    (source / "5.csv").write_text(f"{reordered}\r\n{','.join(cells)}\r\n")
    accepted = run().where("verdict = 'accepted'")
    assert {(r.customer_id, r.address, r.batch) for r in accepted.collect()} == {
        ("1", "10 Long\nRoad, Hull", 0), ("1", "10 Long Road Hull", 2)
    }
    assert run().where("verdict = 'accepted'").count() == 2  # nothing new, nothing twice


def test_a_batch_that_is_taken_up_again_is_stored_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.csv").write_text(f"{HEADER}\n{GOOD}\n")
    daily.validate_new_files(spark, str(source), str(tmp_path), customer_rules(AS_OF)).awaitTermination()
    for commit in (tmp_path / "judged_checkpoint" / "commits").iterdir():
        commit.unlink()  # as if the run had died between the write and its record
    daily.validate_new_files(spark, str(source), str(tmp_path), customer_rules(AS_OF)).awaitTermination()
    assert daily.judged_rows(spark, str(tmp_path)).count() == 1
