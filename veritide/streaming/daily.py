"""The daily run over new files: clean and mask what came in since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veritide import contract
from veritide.operators.clean import clean
from veritide.operators.mask import mask_table
from veritide.operators.rules import Rule, customer_rules
from veritide.operators.validate import with_failed_checks
from veritide.sources.records import MALFORMED, records, tabled
from veritide.sources.tables import CSV_DIALECT, STRICT, text_view

ACCEPTED, QUARANTINED = "accepted", "quarantined"


def mask_new_files(
    spark: SparkSession, source: str, folder: str, multi_line: bool = False
) -> StreamingQuery:
    """Take in every raw CSV file not seen before, write it cleaned and masked, then stop.

    Cleaning and masking look at one row at a time, so they need no state. The checkpoint below
    ``folder`` records which files are done: a run that is lost is taken up again, and no file is
    written twice. Uniqueness is a matter of the whole table and stays with the batch job.
    """
    raw = (
        spark.readStream.schema(contract.SCHEMA)
        .options(**CSV_DIALECT, **STRICT)
        .option("multiLine", multi_line)
        .csv(source)
    )
    return (
        mask_table(clean(text_view(raw)))
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/masked")
    )


def validate_new_files(
    spark: SparkSession, source: str, folder: str, rules: list[Rule] | None = None
) -> StreamingQuery:
    """Take in every raw CSV file not seen before, judge its rows, set apart those that fail, then stop.

    Rows go to ``folder/judged/batch=<number>/verdict=accepted`` or ``.../verdict=quarantined`` in one write, with the file
    they come from, their ``failed_checks`` and, if they don't fit their header, the whole ``malformed_line``. A file
    without a fitting header or with a quote that is not closed is quarantined too, so no file stops this run or a later
    one. A batch that is taken up again overwrites its own folder, so its rows are stored once.
    """
    rules = customer_rules() if rules is None else rules
    lines = spark.readStream.option("lineSep", "\n").text(source).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("text")
    )

    def store(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("line", F.monotonically_increasing_id())
        rows = tabled(records(numbered, refuse=False), contract.COLUMNS, refuse=False).drop("split", "line")
        judged = with_failed_checks(rows, rules, "failed_checks")
        fine = F.col(MALFORMED).isNull() & (F.size("failed_checks") == 0)
        marked = judged.withColumn("verdict", F.when(fine, ACCEPTED).otherwise(QUARANTINED))
        marked.write.mode("overwrite").partitionBy("verdict").parquet(f"{folder}/judged/batch={number}")

    writer = lines.writeStream.foreachBatch(store).option("checkpointLocation", f"{folder}/judged_checkpoint")
    return writer.trigger(availableNow=True).start()


def judged_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All rows that ``validate_new_files`` stored, with their ``batch`` and ``verdict``."""
    fields = ", ".join(f"{c} string" for c in contract.COLUMNS)
    schema = f"file string, {fields}, {MALFORMED} string, failed_checks array<string>, batch bigint, verdict string"
    return spark.read.schema(schema).option("basePath", f"{folder}/judged").parquet(f"{folder}/judged")
