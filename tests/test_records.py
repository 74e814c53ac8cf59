import pytest
from pyspark.sql import functions as F

from veritide.sources import records, tables

CELLS = ['plain', 'say "hi"', 'two\nlines', 'three\n\n"lines"\n', '', ' ', 'comma, comma', "'", 'a\r\nb', '"', '\n', 'é\n字']


def table(spark, n):
    cell = F.element_at(F.array(*[F.lit(c) for c in CELLS]), (F.xxhash64("id") % len(CELLS) + len(CELLS)).cast("int") % len(CELLS) + 1)
    other = F.element_at(F.array(*[F.lit(c) for c in CELLS]), (F.col("id") % len(CELLS) + 1).cast("int"))
    return spark.range(n).select(F.col("id").cast("string").alias("k"), cell.alias("a"), other.alias("b"))


@pytest.mark.parametrize("split", ["200b", "1k", "128m"])
def test_same_rows_as_a_reader_of_whole_files(spark, tmp_path, split):
    path = str(tmp_path / "t")
    tables.write_csv(table(spark, 400).coalesce(1), path)
    expected = sorted(tuple(r) for r in table(spark, 400).collect())
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], split)
        spark.conf.set(names[1], "1b")
        lines = records.read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 4
        found = records.read_csv_marked(spark, path, ["k", "a", "b"])
        assert sorted(tuple(r)[:3] for r in found.collect()) == expected
        assert found.where(F.col(records.MALFORMED).isNotNull()).count() == 0
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    whole = tables.read_csv(spark, path, multi_line=True).select("k", "a", "b")
    assert sorted(tuple(r) for r in whole.collect()) == expected


def test_columns_go_by_the_header_of_their_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,2\n3\n"4\n4",5,6\n')
    (tmp_path / "y.csv").write_text("b,more,a\r\n20,z,10\r\n\r\n30,z\r\n")
    found = {(r.a, r.b, r[records.MALFORMED]) for r in records.read_csv_marked(spark, str(tmp_path), ["a", "b"]).collect()}
    assert found == {("1", "2", None), ("3", "", "3"), ("4\n4", "5", '"4\n4",5,6'), ("10", "20", None), ("", "30", "30,z")}


@pytest.mark.parametrize("header", ["a,c", "a,a,b"])
def test_headers_that_do_not_fit_are_refused(spark, tmp_path, header):
    (tmp_path / "x.csv").write_text(f"{header}\n1,2\n")
    with pytest.raises(ValueError, match="a header"):
        records.read_csv_marked(spark, str(tmp_path), ["a", "b"])


def test_a_quote_that_is_not_closed_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "LINES_PER_RECORD", 50)
    (tmp_path / "x.csv").write_text('a,b\n1,"2\n' + "x,y\n" * 100)
    with pytest.raises(Exception, match="a quote is not closed"):
        records.read_csv_marked(spark, str(tmp_path), ["a", "b"]).collect()


def test_a_file_with_a_header_only(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n")
    assert records.read_csv_marked(spark, str(tmp_path), ["a", "b"]).count() == 0
