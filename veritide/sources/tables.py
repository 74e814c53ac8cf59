"""Reading and writing tables, and the two views of missing values."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritide import contract

CONCURRENT_JOBS = 4
# The quote is doubled inside quotes, and nothing is trimmed.
CSV_DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# A row with more or fewer fields than the header fails, whichever columns are asked for.
STRICT = {"mode": "FAILFAST", "columnPruning": False, "enforceSchema": False}


def read_csv(
    spark: SparkSession, path: str | list[str], row_id: str | None = None, multi_line: bool = False
) -> DataFrame:
    """A CSV with a header as text columns, blank for an empty cell.

    Columns go by the header, so their order does not matter. ``row_id`` names a key column of the
    file; without one the rows are numbered, in the order they have in their file but with gaps.
    ``multi_line`` allows line breaks inside quotes, at the price of one task per file. A row with
    more or fewer fields than the header fails when it is read; no field is lost silently.
    """
    table = spark.read.options(**CSV_DIALECT, **STRICT).option("multiLine", multi_line).csv(path)
    return number_rows(text_view(table), row_id)


def read_parquet(spark: SparkSession, path: str, row_id: str | None = None) -> DataFrame:
    return number_rows(spark.read.parquet(path), row_id)


def number_rows(table: DataFrame, row_id: str | None = None) -> DataFrame:
    """Give the table its ``row_id``, from a column or by position.

    A cell of that column that is no whole number fails when it is read. Whether numbers repeat is
    for ``refuse_repeated_numbers`` to tell.
    """
    if contract.ROW_ID in table.columns and row_id is None:
        return table
    if row_id is None:
        return table.withColumn(contract.ROW_ID, F.monotonically_increasing_id())
    number = F.col(row_id).try_cast("bigint")
    shown = F.coalesce(F.col(row_id).cast("string"), F.lit("null"))
    refused = F.raise_error(F.concat(F.lit(f"column {row_id} has a cell that is no row number: '"), shown, F.lit("'")))
    return table.withColumn(contract.ROW_ID, F.when(number.isNotNull(), number).otherwise(refused.cast("bigint")))


def refuse_repeated_numbers(table: DataFrame) -> None:
    """Fails if two rows share a row number, which reports could not tell apart."""
    counts = table.groupBy(contract.ROW_ID).agg(F.count("*").alias("n_rows"))
    repeated = counts.filter("n_rows > 1").first()
    if repeated:
        raise ValueError(f"{repeated['n_rows']} rows have the row number {repeated[contract.ROW_ID]}")


def text_view(table: DataFrame) -> DataFrame:
    """Every column but the row number as text, blank where it was null."""
    return table.select(
        *[
            F.col(f.name)
            if f.name == contract.ROW_ID
            else F.coalesce(F.col(f.name).cast("string"), F.lit("")).alias(f.name)
            for f in table.schema
        ]
    )


def inferred_view(table: DataFrame) -> DataFrame:
    """Text that an untyped CSV reader takes for missing becomes null. White space does not."""
    return table.select(
        *[
            F.when(~F.col(f.name).isin(contract.NA_TOKENS), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in table.schema
        ]
    )


def customer_columns(table: DataFrame) -> DataFrame:
    """The contract's columns in their order, after the row number if there is one."""
    kept = [contract.ROW_ID] if contract.ROW_ID in table.columns else []
    return table.select(*kept, *contract.COLUMNS)


def write_csv(table: DataFrame, path: str) -> None:
    """Write the columns as CSV parts with a header; the row number is left out."""
    (
        table.drop(contract.ROW_ID)
        .write.mode("overwrite")
        .options(**CSV_DIALECT)
        .option("emptyValue", "")
        .option("nullValue", "")
        .csv(path)
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, on whichever file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(found)


def write_table(table: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and give back the written table, which cuts the lineage."""
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def write_metrics(frames: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write each metric frame as JSON under its name, and give back the written ones.

    The frames do not depend on each other, so their jobs are submitted side by side.
    """

    def write(name: str) -> DataFrame:
        frame = frames[name]
        frame.write.mode("overwrite").json(f"{folder}/{name}")
        return frame.sparkSession.read.schema(frame.schema).json(f"{folder}/{name}")

    with ThreadPoolExecutor(max_workers=CONCURRENT_JOBS) as pool:
        return dict(zip(frames, pool.map(write, frames)))
