"""Every result of a validation from one evaluation of its rules.

One pass over the table judges each row, counts what fails, and writes two kinds of entries side by side: the failures,
and the texts of the unique columns with the number of their row. The counts are observed metrics of that pass, so no
counter is shuffled; they come with the tasks that write, each counted once however often it was tried, because nothing
is shuffled between the counting and the write. Which keys repeat is found from the stored key texts, all unique columns
in one exchange. Reports read what was written: the failures, and a few numbers for each rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from veritide.contract import ROW_ID
from veritide.functions.names import exact
from veritide.functions.numbers import percent
from veritide.functions.text import is_present
from veritide.operators.keys import repeated_keys
from veritide.operators.rules import Rule, customer_rules
from veritide.operators.validate import (
    FAILURE_SCHEMA,
    OWN,
    failure_samples,
    looked_up,
    row_verdicts,
    structural_failures,
    usable_rules,
    with_inputs,
)
from veritide.session import scratch_folder

ENTRY_SCHEMA = f"{FAILURE_SCHEMA}, row_fails boolean, kind string"


@dataclass(frozen=True)
class Judged:
    """The stored failures of a table and the numbers that came with them."""

    failures: DataFrame
    row_count: int
    invalid_row_count: int
    counts: list[tuple[str, str, int]]  # column, check, failures

    @cached_property
    def summary(self) -> DataFrame:
        valid = not any(count for *_, count in self.counts)
        numbers = self.failures.sparkSession.createDataFrame(
            [(self.row_count, self.invalid_row_count, valid)], "row_count bigint, invalid_row_count bigint, is_valid boolean"
        )
        invalid_pct = percent(F.col("invalid_row_count"), F.col("row_count")).alias("invalid_pct")
        return numbers.select("row_count", "invalid_row_count", invalid_pct, "is_valid")

    @cached_property
    def failed_checks(self) -> DataFrame:
        """``column, check, failure_count`` of the checks that fail."""
        failed = [c for c in self.counts if c[2]]
        return self.failures.sparkSession.createDataFrame(failed, "column string, check string, failure_count bigint")

    @cached_property
    def by_check(self) -> DataFrame:
        return self.failed_checks.join(failure_samples(self.failures), ["column", "check"], "left")


def judge(table: DataFrame, rules: list[Rule] | None = None, folder: str | None = None) -> Judged:
    """Judges the table once and stores its failures below ``folder``, by default a new one in the shared scratch folder.

    Any number of columns may be declared unique.
    """
    rules = customer_rules() if rules is None else rules
    spark = table.sparkSession
    folder = folder or scratch_folder(spark)
    _, keys = usable_rules(table, rules)
    verdicts = row_verdicts(table, rules)
    seen = Observation()
    _entries(table, verdicts, keys, seen).write.mode("overwrite").partitionBy("kind").parquet(f"{folder}/entries")
    entries = spark.read.schema(ENTRY_SCHEMA).parquet(f"{folder}/entries")
    failures = entries.where("kind = 'failure'").drop("row_fails", "kind")
    counts = [(r.column, r.check, seen.get[f"rule_{i}"]) for i, r in enumerate(verdicts)]
    invalid = seen.get["invalid"]
    if keys:
        repeated = _repeated(entries, keys, folder)
        failures = failures.unionByName(repeated.drop("row_fails"))
        each = repeated.agg(
            F.count_distinct(F.when(~F.col("row_fails"), F.col(ROW_ID))).alias("invalid"),
            *[F.count_if(F.col("column") == k.column).alias(f"key_{i}") for i, k in enumerate(keys)],
        ).first()
        counts += [(k.column, k.check, each[f"key_{i}"]) for i, k in enumerate(keys)]
        invalid += each["invalid"]
    if structural := structural_failures(table, rules):
        rows = [(None, rule.column, rule.check, case) for rule, case in structural]
        failures = failures.unionByName(spark.createDataFrame(rows, FAILURE_SCHEMA))
        counts += [(rule.column, rule.check, 1) for rule, _ in structural]
    return Judged(failures, seen.get["rows"], invalid, counts)


def _entries(table: DataFrame, verdicts: dict, keys: list[Rule], seen: Observation) -> DataFrame:
    """A row per failure, and one per row and unique column that has a text there.

    The verdicts of a row are one array, the places of the failed rules and null for the others: with a column for each
    rule, the optimizer's constraints on them grow without end.
    """
    rules, place, places, fails = len(verdicts), f"{OWN}_place", f"{OWN}_places", f"{OWN}_fails"
    own = [F.when(~ok, F.lit(i)) for i, ok in enumerate(verdicts.values(), start=1)]
    texts = [F.when(is_present(exact(k.column)), F.lit(i)) for i, k in enumerate(keys, start=rules + 1)]
    judged = with_inputs(table, verdicts).select("*", F.array(*own, *texts).cast("array<int>").alias(places))
    observed = judged.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_any_fails(places, rules)).alias("invalid"),
        *[F.count(F.get(places, F.lit(i))).alias(f"rule_{i}") for i in range(rules)],
    )
    column, check, value = looked_up(F.col(place), [*verdicts, *keys])
    exploded = observed.select("*", _any_fails(places, rules).alias(fails), F.explode(places).alias(place))
    return exploded.where(F.col(place).isNotNull()).select(
        ROW_ID,
        column.alias("column"),
        check.alias("check"),
        value.alias("failure_case"),
        F.col(fails).alias("row_fails"),
        F.when(F.col(place) > rules, "key").otherwise("failure").alias("kind"),
    )


def _any_fails(places: str, rules: int) -> Column:
    return F.exists(F.slice(places, 1, rules), lambda p: p.isNotNull()) if rules else F.lit(False)


def _repeated(entries: DataFrame, keys: list[Rule], folder: str) -> DataFrame:
    """The stored entries of keys that repeat."""
    keyed = entries.where("kind = 'key'").drop("kind")
    repeated_keys(keyed, ["column", "failure_case"]).write.mode("overwrite").parquet(f"{folder}/repeated")
    return entries.sparkSession.read.schema(keyed.schema).parquet(f"{folder}/repeated")
