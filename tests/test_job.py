from pathlib import Path

import pandas as pd
import pytest
from conftest import AS_OF

from veritide import contract
from veritide.__main__ import main
from veritide.plans.job import STAGES, StageFailed, run_job
from veritide.plans.published import Published
from veritide.sources.tables import read_csv, write_csv
from veritide.streaming.daily import mask_new_files


def write_raw(path, rows):
    pd.DataFrame(rows, columns=contract.COLUMNS).to_csv(path, index=False)


def test_job_writes_every_result(spark, tmp_path, valid_rows):
    rows = [list(r) for r in valid_rows]
    rows[0][1], rows[0][4], rows[1][5] = "nora", "(212) 555-0101", "11/30/1992"
    write_raw(tmp_path / "raw.csv", rows)
    report = run_job(spark, str(tmp_path / "raw.csv"), str(tmp_path / "out"), AS_OF, csv_output=True)
    assert report.status == "SUCCESS"
    assert [(s.name, s.status) for s in report.stages] == [(name, "SUCCESS") for name in STAGES]
    details = {s.name: s.details for s in report.stages}
    assert details["validate_raw"] == {"invalid_row_count": 1, "row_count": 3}
    assert details["clean_and_revalidate"] == {"rows_out": 3, "post_clean_invalid_row_count": 0}
    for folder in (
        "raw", "quality/completeness", "quality/types", "quality/status_counts", "pii/pii_occurrences",
        "validation/summary", "validation/by_check", "validation/failures", "cleaning/normalization",
        "cleaning/missing_values", "cleaning/phases", "cleaned", "cleaned_csv", "masked", "masked_csv",
        "masking/masked_sample", "execution/stages",
    ):
        assert (Path(tmp_path) / "out" / folder / "_SUCCESS").exists(), folder
    masked = read_csv(spark, str(tmp_path / "out/masked_csv")).collect()
    assert {r.first_name for r in masked} == {"N***", "O***", "P***"}


def test_failure_is_reported_and_raised(spark, tmp_path):
    with pytest.raises(StageFailed):
        run_job(spark, str(tmp_path / "none.csv"), str(tmp_path / "out"), AS_OF)
    stages = spark.read.json(str(tmp_path / "out/execution/stages")).collect()
    assert [(s.stage, s.status) for s in stages] == [("sense_raw_data", "FAILED")]
    assert "PATH_NOT_FOUND" in stages[0].error
    assert spark.read.json(str(tmp_path / "out/execution/run")).first().status == "FAILED"


def test_failure_halts_the_later_stages(spark, tmp_path, customers, valid_rows):
    with pytest.raises(StageFailed):
        run_job(spark, customers(*valid_rows).drop("phone"), str(tmp_path / "out"), AS_OF)
    stages = spark.read.json(str(tmp_path / "out/execution/stages")).orderBy("stage").collect()
    assert {s.stage: s.status for s in stages} == {"sense_raw_data": "SUCCESS", "profile_quality": "FAILED"}


def test_daily_run_takes_each_file_once(spark, tmp_path, customers, valid_rows):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for day, row in enumerate(valid_rows[:2]):
        write_raw(source / f"day{day}.csv", [row])
        mask_new_files(spark, str(source), str(out)).awaitTermination(120)
        found = spark.read.parquet(str(out / "masked")).collect()
        assert sorted(r.customer_id for r in found) == ["1", "2"][: day + 1]
    assert {r.first_name for r in found} == {"N***", "O***"}


def test_job_agrees_with_the_csv_it_writes(spark, tmp_path, raw_at):
    raw = raw_at("0.001")
    write_csv(raw, str(tmp_path / "raw"))
    by_file = run_job(spark, str(tmp_path / "raw"), str(tmp_path / "a"), AS_OF)
    by_table = run_job(spark, raw, str(tmp_path / "b"), AS_OF)
    assert [s.details for s in by_file.stages] == [s.details for s in by_table.stages]


def test_command_line(spark, tmp_path, capsys):
    main(["generate", str(tmp_path / "raw"), "--rows", "30", "--seed", "3"])
    raw = read_csv(spark, str(tmp_path / "raw"))
    assert raw.count() == 30
    assert raw.columns[:-1] == contract.COLUMNS
    main(["run", str(tmp_path / "raw"), str(tmp_path / "out"), "--as-of", "2026-01-01"])
    assert capsys.readouterr().out.count("SUCCESS") == 6


def test_stored_table_is_not_copied(spark, tmp_path, raw_at):
    raw_at("0.001").write.parquet(str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    report = run_job(spark, table, str(tmp_path / "out"), AS_OF, stored=True)
    assert report.stages[3].details == {"invalid_row_count": 70, "row_count": 150}
    assert not (tmp_path / "out/raw").exists()
    with pytest.raises(StageFailed, match="row numbers"):
        run_job(spark, table.drop("row_id"), str(tmp_path / "no"), AS_OF, stored=True)


def test_stages_run_one_by_one(spark, tmp_path, raw_at):
    write_csv(raw_at("0.001"), str(tmp_path / "raw"))
    whole = run_job(spark, str(tmp_path / "raw"), str(tmp_path / "a"), AS_OF)
    single = [
        run_job(spark, str(tmp_path / "raw") if name == "sense_raw_data" else None, str(tmp_path / "b"), AS_OF, stages=[name])
        for name in STAGES
    ]
    assert [s.stages[0].details for s in single] == [s.details for s in whole.stages]


@pytest.mark.parametrize("source", ["raw", "cleaned", "", "raw/part"])
def test_a_source_that_the_job_would_write_is_refused(spark, tmp_path, valid_rows, source):
    (tmp_path / source).mkdir(parents=True, exist_ok=True)
    kept = tmp_path / source / "a.csv"
    write_raw(kept, valid_rows)
    before = kept.read_bytes()
    with pytest.raises(ValueError, match="overlaps"):
        run_job(spark, str(tmp_path / source), str(tmp_path), AS_OF)
    assert kept.read_bytes() == before and not (tmp_path / "execution").exists()


def test_an_attempt_that_dies_leaves_the_version_before_it(spark, tmp_path, customers, valid_rows):
    out = str(tmp_path / "out")
    run_job(spark, customers(*valid_rows), out, AS_OF)
    published = Published(spark, out)
    before = published.last()
    assert {v.version for v in before.values()} == {1} and {v.place for v in before.values()} == {out}
    twice = customers(*valid_rows[:2]).unionAll(customers(*valid_rows[:2]))
    with pytest.raises(StageFailed, match="row number"):
        run_job(spark, twice, out, AS_OF, row_id="row_id", stages=["sense_raw_data"])
    assert len(list((tmp_path / "out/attempts").glob("*/raw/_SUCCESS"))) == 1  # written, and not published
    assert published.last() == before
    again = run_job(spark, None, out, AS_OF, stages=["profile_quality"])
    assert again.stages[0].details["row_count"] == 3
    assert published.last()["profile_quality"].version == 2
    assert spark.read.parquet(f"{out}/raw").count() == 3


def test_a_new_version_lies_beside_the_old_one(spark, tmp_path, customers, valid_rows):
    out = str(tmp_path / "out")
    run_job(spark, customers(*valid_rows), out, AS_OF)
    old = spark.read.parquet(f"{out}/masked")
    run_job(spark, customers(*valid_rows[:2]), out, AS_OF)
    assert old.count() == 3
    last = Published(spark, out).last()
    assert spark.read.parquet(f"{last['mask_pii'].place}/masked").count() == 2
    assert last["mask_pii"].made_from == {"clean_and_revalidate": 2}


def test_results_that_do_not_belong_together_are_refused(spark, tmp_path, customers, valid_rows):
    out = str(tmp_path / "out")
    run_job(spark, customers(*valid_rows), out, AS_OF, stages=["sense_raw_data", "validate_raw"])
    with pytest.raises(StageFailed, match="takes ages at"):
        run_job(spark, None, out, AS_OF.replace(year=2027), stages=["clean_and_revalidate"])
    run_job(spark, customers(*valid_rows[:2]), out, AS_OF, stages=["sense_raw_data"])
    with pytest.raises(StageFailed, match="version 1 of sense_raw_data, which is at 2"):
        run_job(spark, None, out, AS_OF, stages=["clean_and_revalidate"])
    with pytest.raises(StageFailed, match="needs clean_and_revalidate"):
        run_job(spark, None, out, AS_OF, stages=["mask_pii"])


def test_command_line_reads_parquet(spark, tmp_path, capsys, customers, valid_rows):
    customers(*valid_rows).drop("row_id").write.parquet(str(tmp_path / "raw"))
    main(["run", str(tmp_path / "raw"), str(tmp_path / "out"), "--format", "parquet", "--as-of", "2026-01-01", "--stage", "sense_raw_data"])
    assert "'row_count': 3" in capsys.readouterr().out
