import pandas as pd
import pytest
from pyspark.errors import AnalysisException

from veritide import contract
from veritide.sources import tables

ODD = [
    ("1", 'say "hi", you', " padded ", "", "back\\slash", "a\tb", "comma, comma", "'", '"', "NA"),
    ("", "", "", "", "", "", "", "", "", "x"),
    ("é", "　", "null", "None", "1e3", "#", "a;b", "|", "--", "\\N"),
]


def frame(spark):
    return spark.createDataFrame(ODD, ", ".join(f"{c} string" for c in contract.COLUMNS))


def test_csv_round_trip(spark, tmp_path):
    tables.write_csv(frame(spark), str(tmp_path / "out"))
    back = tables.read_csv(spark, str(tmp_path / "out"))
    assert sorted(tuple(r)[:-1] for r in back.collect()) == sorted(ODD)
    assert back.columns == [*contract.COLUMNS, "row_id"]


def test_reads_what_pandas_writes_and_the_other_way(spark, tmp_path):
    pd.DataFrame(ODD, columns=contract.COLUMNS).to_csv(tmp_path / "a.csv", index=False)
    read = tables.read_csv(spark, str(tmp_path / "a.csv"))
    assert [tuple(r)[:-1] for r in read.orderBy("row_id").collect()] == ODD
    tables.write_csv(frame(spark).coalesce(1), str(tmp_path / "b"))
    part = next((tmp_path / "b").glob("*.csv"))
    again = pd.read_csv(part, dtype=str, keep_default_na=False)
    assert list(again.itertuples(index=False, name=None)) == ODD


def test_columns_go_by_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a,extra\n1,2,3\n")
    row = tables.read_csv(spark, str(tmp_path / "a.csv")).first()
    assert (row.a, row.b, row.extra) == ("2", "1", "3")


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n"x\ny",1\n')
    assert tables.read_csv(spark, str(tmp_path / "a.csv"), multi_line=True).first().a == "x\ny"


def test_key_column_as_row_number(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n41,x\n42,y\n")
    rows = tables.read_csv(spark, str(tmp_path / "a.csv"), row_id="a").collect()
    assert [r.row_id for r in rows] == [41, 42]


@pytest.mark.parametrize("cell", ["", "x1", "1.5e400"])
def test_a_key_that_is_no_number_is_refused(spark, tmp_path, cell):
    (tmp_path / "a.csv").write_text(f"a,b\n41,x\n{cell},y\n")
    with pytest.raises(Exception, match="column a has a cell that is no row number"):
        tables.read_csv(spark, str(tmp_path / "a.csv"), row_id="a").collect()


def test_repeated_row_numbers_are_refused(spark):
    numbers = spark.createDataFrame([(1,), (2,), (2,)], "row_id long")
    tables.refuse_repeated_numbers(numbers.distinct())
    with pytest.raises(ValueError, match="2 rows have the row number 2"):
        tables.refuse_repeated_numbers(numbers)


def test_absent_source_fails_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException):
        tables.read_csv(spark, str(tmp_path / "none.csv"))


def test_written_table_comes_back(spark, tmp_path):
    table = tables.number_rows(tables.text_view(frame(spark)))
    back = tables.write_table(table, str(tmp_path / "t"))
    assert sorted(back.collect()) == sorted(table.collect())
    assert tables.read_parquet(spark, str(tmp_path / "t")).columns == table.columns


@pytest.mark.parametrize("row", ["4,5,6,7,8", "9"])
def test_rows_with_other_numbers_of_fields_fail(spark, tmp_path, row):
    (tmp_path / "a.csv").write_text(f"a,b,c\n1,2,3\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        tables.read_csv(spark, str(tmp_path / "a.csv")).select("a").collect()
