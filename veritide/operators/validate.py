"""Judge every row by every rule, and report all failures rather than the first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritide.contract import ROW_ID
from veritide.functions.names import exact
from veritide.functions.numbers import percent
from veritide.functions.text import is_present
from veritide.operators.keys import repeated_rows
from veritide.operators.rules import UNIQUE, Rule, customer_rules

NOT_NULL = "not_null"
OWN = "__veritide"  # how the names of helper columns begin
SAMPLE_ROWS = 5
FAILURE_SCHEMA = f"{ROW_ID} bigint, column string, check string, failure_case string"


def structural_failures(table: DataFrame, rules: list[Rule]) -> list[tuple[Rule, str]]:
    """Columns that are absent or not text, with the case. They concern no single row."""
    types = {f.name: f.dataType for f in table.schema}
    found = []
    for column in dict.fromkeys(rule.column for rule in rules):
        if column not in types:
            found.append((Rule(column, "column_in_table"), column))
        elif not isinstance(types[column], T.StringType):
            found.append((Rule(column, "dtype"), types[column].simpleString()))
    return found


def usable_rules(table: DataFrame, rules: list[Rule]) -> tuple[list[Rule], list[Rule]]:
    """The rules on columns that are there, and apart from them those on keys."""
    unusable = {rule.column for rule, _ in structural_failures(table, rules)}
    usable = [rule for rule in rules if rule.column not in unusable]
    return [rule for rule in usable if rule.check != UNIQUE], [rule for rule in usable if rule.check == UNIQUE]


def row_verdicts(table: DataFrame, rules: list[Rule]) -> dict[Rule, Column]:
    """A boolean per rule that one row decides, and per text column that may hold nulls."""
    by_row, _ = usable_rules(table, rules)
    nullable = {f.name for f in table.schema if f.nullable}
    present, read = _helpers(by_row)

    def verdict(rule: Rule) -> Column:
        value = F.col(read[rule.column, rule.reads]) if rule.reads else exact(rule.column)
        return rule.verdict(F.col(present[rule.column]), value)

    return {
        **{Rule(c, NOT_NULL): exact(c).isNotNull() for c in present if c in nullable},
        **{rule: verdict(rule) for rule in by_row},
    }


def _helpers(rules: list[Rule]) -> tuple[dict[str, str], dict[tuple, str]]:
    """Names of the columns that tell, by column, whether its value is present, and that hold, by
    column and reader, the value as read. They go by position, so every run has the same plan."""
    columns = dict.fromkeys(rule.column for rule in rules)
    readers = dict.fromkeys((rule.column, rule.reads) for rule in rules if rule.reads)
    return (
        {c: f"{OWN}_present_{i}" for i, c in enumerate(columns)},
        {r: f"{OWN}_read_{i}" for i, r in enumerate(readers)},
    )


def with_inputs(table: DataFrame, verdicts: dict[Rule, Column]) -> DataFrame:
    """The table with what the verdicts are made from, in a projection of its own.

    A parsed date or number serves several conditions; as a column it is parsed once per row.
    """
    present, read = _helpers([rule for rule in verdicts if rule != Rule(rule.column, NOT_NULL)])
    return table.select(
        "*",
        *[is_present(exact(c)).alias(name) for c, name in present.items()],
        *[reads(exact(c)).alias(name) for (c, reads), name in read.items()],
    )


def row_checks(table: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per input row, with a boolean per rule named ``column__check``."""
    rules = customer_rules() if rules is None else rules
    verdicts = row_verdicts(table, rules)
    checked = with_inputs(table, verdicts).select(
        ROW_ID, *[ok.alias(rule.name) for rule, ok in verdicts.items()]
    )
    _, keys = usable_rules(table, rules)
    if not keys:
        return checked
    # The join is on the row number, so a hot key does not gather its rows anywhere.
    flags = [F.bool_or(F.col("column") == k.column).alias(f"{OWN}_key_{i}") for i, k in enumerate(keys)]
    repeated = repeated_rows(table, *[k.column for k in keys]).groupBy(ROW_ID).agg(*flags)
    marked = checked.join(repeated, ROW_ID, "left")
    fine = [~F.coalesce(F.col(f"{OWN}_key_{i}"), F.lit(False)) for i in range(len(keys))]
    return marked.select(*[exact(c) for c in checked.columns], *[ok.alias(k.name) for k, ok in zip(keys, fine)])


def with_failed_checks(table: DataFrame, rules: list[Rule], name: str) -> DataFrame:
    """The table with the array ``name`` of the checks (``column__check``) that each row fails; uniqueness is not among
    them."""
    verdicts = row_verdicts(table, rules)
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(rule.name)) for rule, ok in verdicts.items()]).cast("array<string>"))
    return with_inputs(table, verdicts).select(*[exact(c) for c in table.columns], failed.alias(name))


def failure_cases(table: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per input row and failed check, with the value that failed.

    Rules on single rows need no shuffle, and each is evaluated once: a filter on "any rule failed"
    before ``explode`` would be pushed down and evaluate all of them a second time. Only the places
    of failed rules are exploded; names and values are looked up for those.
    """
    rules = customer_rules() if rules is None else rules
    verdicts = row_verdicts(table, rules)
    places = [F.when(~ok, F.lit(i)) for i, ok in enumerate(verdicts.values(), start=1)]
    place = F.col(f"{OWN}_place")
    column, check, value = looked_up(place, list(verdicts))
    found = (
        with_inputs(table, verdicts)
        .select("*", F.explode(F.array(*places)).alias(f"{OWN}_place"))
        .filter(place.isNotNull())
        .select(ROW_ID, column.alias("column"), check.alias("check"), value.alias("failure_case"))
    )
    _, keys = usable_rules(table, rules)
    if keys:
        repeated = repeated_rows(table, *[k.column for k in keys])
        found = found.unionByName(
            repeated.select(ROW_ID, "column", F.lit(UNIQUE).alias("check"), F.col("key_text").alias("failure_case"))
        )
    structural = structural_failures(table, rules)
    if structural:
        rows = [(None, rule.column, rule.check, case) for rule, case in structural]
        found = found.unionByName(table.sparkSession.createDataFrame(rows, FAILURE_SCHEMA))
    return found


def looked_up(place: Column, rules: list[Rule]) -> tuple[Column, Column, Column]:
    """Column, check and value of the rule at ``place``, from 1."""
    columns, checks = ([getattr(rule, part) for rule in rules] for part in ("column", "check"))
    return _name_at(place, columns), _name_at(place, checks), _value_at(place, rules)


def _name_at(place: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in names]), place)


def _value_at(place: Column, rules) -> Column:
    """The value of the column that the rule at ``place`` judges."""
    places: dict[str, list[int]] = {}
    for i, rule in enumerate(rules, start=1):
        places.setdefault(rule.column, []).append(i)
    value = F.lit(None).cast("string")
    for column, own in places.items():
        value = F.when(place.isin(own), exact(column)).otherwise(value)
    return value


def summarize_failures(failures: DataFrame, row_count: int) -> DataFrame:
    """The summary of a table of ``row_count`` rows from its failures.

    With the failures written, this spares judging the table again: only the row numbers of rows
    that fail are shuffled, once per task.
    """
    found = failures.agg(
        F.count_distinct(ROW_ID).alias("invalid_row_count"), F.count("*").alias("failures")
    )
    return found.select(
        F.lit(row_count).cast("bigint").alias("row_count"),
        "invalid_row_count",
        percent(F.col("invalid_row_count"), F.lit(row_count)).alias("invalid_pct"),
        (F.col("failures") == 0).alias("is_valid"),
    )


def count_failures(failures: DataFrame) -> DataFrame:
    """``column, check, failure_count, sample_row_ids`` from the failures."""
    counts = failures.groupBy("column", "check").agg(F.count("*").alias("failure_count"))
    return counts.join(failure_samples(failures), ["column", "check"], "left")


def failure_samples(failures: DataFrame, size: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows of each failed check, by row number.

    Spark limits each task to its own first rows before the shuffle (WindowGroupLimit), so a check
    that a third of the table fails does not meet in one task.
    """
    by_check = Window.partitionBy("column", "check").orderBy(ROW_ID)
    return (
        failures.filter(F.col(ROW_ID).isNotNull())
        .select("column", "check", ROW_ID, F.row_number().over(by_check).alias("place"))
        .filter(F.col("place") <= size)
        .groupBy("column", "check")
        .agg(F.array_sort(F.collect_list(ROW_ID)).alias("sample_row_ids"))
    )
