"""CSV records from lines: quotes over line breaks, headers by file, and bad records set apart.

Files are read as lines, so one large file is read by many tasks, and a quoted line break is found afterwards: a line
starts a record if an even number of quotes stand before it in its file. Each split of a file counts its quotes, the few
counts of a file's splits are added up in order, and a split then knows how its first line stands. Lines that are records of
their own go straight on; only those of a longer record meet, by the line that starts it.

The first record of a file is its header, and the fields of its other records go by it, whatever order another file has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritide.functions.names import exact

#: Lines that a record can have; a quote that is never closed fails there and does not gather the rest of a file.
LINES_PER_RECORD = 10_000
#: Different headers that the files of one read can have.
HEADERS = 1_000
MALFORMED = "malformed_line"
DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file``, ``split`` (where the line's part of the file starts), ``line`` (its order there) and ``text``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(*line_columns())


def line_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
    ]


def records(lines: DataFrame, refuse: bool = True) -> DataFrame:
    """``file``, ``split``, ``line`` (those of its first line) and ``text`` of each record; line breaks inside quotes stay.

    A quote that is not closed within ``LINES_PER_RECORD`` fails, or, if nothing is to be refused, leaves lines that are
    ``broken``.
    """
    place = Window.partitionBy("file", "split").orderBy("line")
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    so_far = place.rowsBetween(Window.unboundedPreceding, 0)
    quotes = (F.length("text") - F.length(F.replace("text", F.lit('"')))).alias("quotes")
    counted = lines.select("file", "split", "line", "text", quotes)
    # Whether quotes are open at the start of each split.
    splits = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    totals = counted.groupBy("file", "split").agg(F.sum("quotes").alias("quotes"))
    opened = totals.select("file", "split", F.coalesce(F.sum("quotes").over(splits), F.lit(0)).alias("opened"))
    known = counted.join(opened, ["file", "split"])
    inside = (F.col("opened") + F.coalesce(F.sum("quotes").over(before), F.lit(0))) % 2 == 1
    known = known.withColumn("starts", ~inside)
    own = F.when(F.col("starts"), F.struct("split", "line"))
    known = known.withColumn("first", F.last(own, ignorenulls=True).over(so_far))
    # A record that a split's first lines go on with starts in an earlier split.
    last = known.groupBy("file", "split").agg(F.max(own).alias("last"))
    carried = last.select("file", "split", F.last("last", ignorenulls=True).over(splits).alias("carried"))
    placed = known.drop("opened").join(carried, ["file", "split"]).withColumn("first", F.coalesce("first", "carried"))
    alone = F.col("starts") & (F.col("quotes") % 2 == 0)
    row = ["file", "split", "line", _ended("text").alias("text")]
    whole = placed.where(alone).select(*row, F.lit(False).alias("broken"))
    parts = placed.where(~alone).select("file", "first", "split", "line", "text")
    sizes = parts.groupBy("file", "first").agg(F.count("*").alias("lines"))
    few = F.col("lines") <= LINES_PER_RECORD
    if refuse:
        few = F.when(few, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("file"))).cast("boolean"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "line", "text"))), lambda x: x["text"]), "\n")
    long = parts.join(sizes.where(few).select("file", "first"), ["file", "first"]).groupBy("file", "first").agg(joined.alias("text"))
    found = whole.unionByName(long.select("file", "first.split", "first.line", _ended("text").alias("text"), F.lit(False).alias("broken")))
    if refuse:
        return found
    endless = parts.join(sizes.where(~few).select("file", "first"), ["file", "first"], "left_semi")
    return found.unionByName(endless.select(*row, F.lit(True).alias("broken")))


def _ended(text: str) -> Column:
    return F.regexp_replace(text, "\r$", "")


def fields(text: Column, columns: list[str]) -> Column:
    """The fields of a record by name, and ``MALFORMED`` with the record if it has more or fewer of them."""
    names = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join(f"{n} string" for n in [*names, MALFORMED])
    options = {**DIALECT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "lineSep": "\n"}
    parsed = F.from_csv(text, schema, options)
    cells = [F.coalesce(parsed[n], F.lit("")).alias(c) for n, c in zip(names, columns)]
    return F.struct(*cells, parsed[MALFORMED].alias(MALFORMED))


def tabled(found: DataFrame, columns: list[str], refuse: bool = True) -> DataFrame:
    """Records as the named columns and ``MALFORMED``, each file's by its own header, with ``file``, ``split`` and ``line``.

    Columns that a header has besides are left out; one without all of them fails, and so does a header that repeats a
    name. If nothing is to be refused, the records of such a file are malformed ones. Records without text are no rows.
    """
    heads = found.groupBy("file").agg(F.min(F.struct("split", "line", "text")).alias("head"))
    distinct = [r["text"] for r in heads.select(F.col("head.text").alias("text")).distinct().limit(HEADERS + 1).collect()]
    if len(distinct) > HEADERS:
        raise ValueError(f"the files have more than {HEADERS} different headers")
    rows = found.join(heads, "file").where((F.col("split") != F.col("head.split")) | (F.col("line") != F.col("head.line")))
    rows = rows.where("trim(text) <> ''").select("file", "split", "line", "text", "broken", F.col("head.text").alias("header"))
    tables = []
    for header in distinct:
        names = _names(found.sparkSession, header)
        lost = [c for c in columns if c not in names]
        unfit = f"lacks {', '.join(lost)}" if lost else "repeats a name" if len(set(names)) < len(names) else None
        if unfit and refuse:
            raise ValueError(f"a header {unfit}: {header[:200]}")
        own = rows.where(F.col("header") == header)
        if unfit:
            cells, bad = [F.lit("").alias(c) for c in columns], F.col("text")
        else:
            own = own.withColumn("row", fields(F.col("text"), names))
            cells = [F.col("row").getField(c).alias(c) for c in columns]
            bad = F.when(F.col("broken"), F.col("text")).otherwise(F.col("row").getField(MALFORMED))
        tables.append(own.select("file", "split", "line", *cells, bad.alias(MALFORMED)))
    if not tables:
        empty = ", ".join(f"`{c}` string" for c in [*columns, MALFORMED])
        return found.sparkSession.createDataFrame([], f"file string, split bigint, line bigint, {empty}")
    table = tables[0]
    for other in tables[1:]:
        table = table.unionByName(other)
    return table


def _names(spark: SparkSession, header: str) -> list[str]:
    """The cells of a header, as Spark's reader reads them."""
    schema = F.schema_of_csv(header, {**DIALECT, "inferSchema": "false"})
    width = len(spark.range(1).select(F.from_csv(F.lit(header), schema, DIALECT).alias("x")).select("x.*").columns)
    own = ", ".join(f"c{i} string" for i in range(width))
    row = spark.range(1).select(F.from_csv(F.lit(header), own, DIALECT).alias("x")).select("x.*").first()
    return [cell or "" for cell in row]


def read_csv_marked(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """The CSV rows as text columns by the header of their file, with ``MALFORMED`` holding the whole record of a row that
    has more or fewer fields than its header and null for every other row, so that no field is lost.

    For input whose bad rows are to be set aside; ``read_csv`` fails on them instead. Quotes may hold line breaks, and a
    large file is read by many tasks all the same.
    """
    return tabled(records(read_lines(spark, path)), columns).select(*[exact(c) for c in [*columns, MALFORMED]])
