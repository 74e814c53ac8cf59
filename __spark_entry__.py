
from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracles  # noqa: E402
from veritide.contract import COLUMNS, KEY, ROW_ID  # noqa: E402
from veritide.functions.normalize import normalize_date, normalize_name, normalize_phone  # noqa: E402
from veritide.llm.common import settled  # noqa: E402
from veritide.operators import clean, mask, pii, profile, profile_history, text_pii, validate  # noqa: E402
from veritide.operators.judge import judge  # noqa: E402
from veritide.operators.key_history import KeyHistory  # noqa: E402
from veritide.operators.keys import repeated_rows  # noqa: E402
from veritide.operators.profile_history import ProfileHistory  # noqa: E402
from veritide.operators.renumber import dense_numbers  # noqa: E402
from veritide.operators.rules import Rule, customer_rules  # noqa: E402
from veritide.plans.job import RECORD, STAGES, StageFailed, run_job  # noqa: E402
from veritide.plans.published import Published  # noqa: E402
from veritide.session import scratch_folder  # noqa: E402
from veritide.sources import records, tables  # noqa: E402
from veritide.sources.faults import customers_for  # noqa: E402
from veritide.sources.messy_customers import messy_customers  # noqa: E402
from veritide.streaming import daily  # noqa: E402

AS_OF = dt.date(2026, 1, 1)
EVENT_TYPES = ["click", "view", "purchase"]

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Failures by column and rule, with the first rows of each."""
    return queries()["failures_by_check"](spark, "/root/testdata/sf0.001")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_customers(spark, _table(spark, sf_dir, "customer"))


def _on_raw(work: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: work(_raw(spark, sf_dir))


def _on_inferred(work: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: work(tables.inferred_view(_raw(spark, sf_dir)))


def _on(name: str, work: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: work(_table(spark, sf_dir, name))


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    tables.write_csv(_raw(spark, sf_dir), folder)
    return tables.customer_columns(tables.read_csv(spark, folder)).drop(ROW_ID)


def _failures_by_check(raw: DataFrame) -> DataFrame:
    by_check = judge(raw, customer_rules(AS_OF)).by_check
    return by_check.withColumn("sample_row_ids", F.array_join("sample_row_ids", ","))


def _summary(raw: DataFrame) -> DataFrame:
    return judge(raw, customer_rules(AS_OF)).summary


def _drop_fill_flag(raw: DataFrame) -> DataFrame:
    cleaned = clean.clean(raw, review=True)
    return cleaned.withColumn(clean.REVIEW, F.array_join(clean.REVIEW, ","))


def _before_after(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return clean.before_after(raw, clean.clean(raw), customer_rules(AS_OF))


def _repeated(table: DataFrame, key: str) -> DataFrame:
    return profile.repeated_keys(table, key).select(F.col("text").alias(key), "row_count")


def _normalized_dates(raw: DataFrame) -> DataFrame:
    return raw.select(
        ROW_ID,
        F.col("date_of_birth").alias("raw_birth"),
        normalize_date(F.col("date_of_birth")).alias("birth"),
        F.col("created_date").alias("raw_created"),
        normalize_date(F.col("created_date")).alias("created"),
    )


def _normalized_names(raw: DataFrame) -> DataFrame:
    return raw.select(
        ROW_ID,
        F.col("first_name").alias("raw_first"),
        normalize_name(F.col("first_name")).alias("first"),
        F.col("last_name").alias("raw_last"),
        normalize_name(F.col("last_name")).alias("last"),
    )


def _generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated customer for every key of the customer table."""
    customer = _table(spark, sf_dir, "customer")
    ids = customer.select((F.col("c_custkey").cast("bigint") + 1).alias(ROW_ID))
    return customers_for(ids, customer.count(), as_of=AS_OF)


def _generated_exact_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many generated rows carry another row's id, at three rates, for as many rows as there are customers.

    Row 16 lacks its own id unless it took one.
    """
    customer = _table(spark, sf_dir, "customer")
    ids = dense_numbers(customer.select(F.col("c_custkey").cast("bigint").alias(ROW_ID)), "place")
    # Each rate takes several passes over the numbers, so they are made once.
    numbers, n_rows = settled(ids.select((F.col("place") + 1).alias(ROW_ID))), customer.count()
    found = []
    for rate in (0.02, 0.1, 0.3):
        made = customers_for(numbers, n_rows, error_rate=0, duplicate_rate=rate, as_of=AS_OF, exact_duplicates=True)
        other = F.count_if(F.col(KEY) != F.col(ROW_ID).cast("string"))
        blank = F.count_if((F.col(ROW_ID) == 16) & (F.col(KEY) == ""))
        found.append(made.agg(F.lit(rate).alias("rate"), F.count("*").alias("rows"), (other - blank).alias("repeats")))
    return reduce(DataFrame.unionByName, found)


def _profile_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of three days merged from what was kept of each, and whether distinct values are within the stated error."""
    seen = tables.inferred_view(_raw(spark, sf_dir))
    history = ProfileHistory(spark, scratch_folder(spark))
    for day in (0, 1, 2, 1):
        history.add(f"day-{day}", seen.where(F.col(ROW_ID) % 3 == day))
    merged = history.merged()
    distinct = seen.agg(*[F.count_distinct(c).alias(c) for c in COLUMNS])
    exact = distinct.select(F.explode(F.create_map(*[x for c in COLUMNS for x in (F.lit(c), F.col(c))])).alias("column", "distinct"))
    apart = F.abs(F.col("distinct_estimate") - F.col("distinct")) <= F.ceil(F.col("distinct") * profile_history.ERROR)
    return merged.join(F.broadcast(exact), "column").select(*merged.columns[:-1], apart.alias("within_error"))


def _csv_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written with a surplus field or without their last one, set apart when read."""
    raw, folder = _raw(spark, sf_dir), scratch_folder(spark)
    surplus, short = F.col(ROW_ID) % 40 == 7, F.col(ROW_ID) % 50 == 9
    written = {**records.DIALECT, "emptyValue": "", "nullValue": ""}
    whole, most = (F.to_csv(F.struct(*some), written) for some in (COLUMNS, COLUMNS[:-1]))
    line = F.when(surplus, F.concat(whole, F.lit(",x"))).when(short, most).otherwise(whole)
    # One column, whose name is the header, in a dialect that leaves its text as it is.
    lines = raw.select(line.alias(",".join(COLUMNS)))
    lines.write.options(header=True, sep="\u0001", quote="\u0002", ignoreTrailingWhiteSpace=False).csv(folder)
    read = records.read_csv_marked(spark, folder, COLUMNS)
    return read.select("customer_id", "email", F.col(records.MALFORMED).isNotNull().alias("malformed"))


def _csv_reordered_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of files whose headers have the columns in two orders, one with a column more."""
    raw, folder = _raw(spark, sf_dir), scratch_folder(spark)
    odd = F.col(ROW_ID) % 2 == 1
    tables.write_csv(raw.where(~odd), f"{folder}/even")
    tables.write_csv(raw.where(odd).select(ROW_ID, F.lit("x").alias("more"), *reversed(COLUMNS)), f"{folder}/odd")
    return records.read_csv_marked(spark, [f"{folder}/even", f"{folder}/odd"], COLUMNS).drop(records.MALFORMED)


def _csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with quotes and line breaks in their cells, from files that many tasks read."""
    folder = scratch_folder(spark)
    address = F.concat(F.lit('"The" '), "address", F.lit('\nFloor "2"\n'))
    tables.write_csv(_raw(spark, sf_dir).withColumn("address", address).coalesce(1), folder)
    return records.read_csv_marked(spark, folder, COLUMNS).drop(records.MALFORMED)


def _csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    address = F.concat("address", F.lit("\nFloor 2"))
    tables.write_csv(_raw(spark, sf_dir).withColumn("address", address), folder)
    return tables.customer_columns(tables.read_csv(spark, folder, multi_line=True)).drop(ROW_ID)


def _hot_key_repeats(lines: DataFrame) -> DataFrame:
    """Rows of repeated keys, one of which a third of all rows or so share."""
    hot = F.when(F.col("l_linenumber") % 3 == 1, F.lit("hot"))
    key = F.coalesce(hot, F.concat_ws("-", "l_partkey", "l_suppkey"))
    number = (F.col("l_orderkey").cast("bigint") * 100 + F.col("l_linenumber")).alias(ROW_ID)
    found = repeated_rows(lines.select(number, key.alias("line_key")), "line_key")
    return found.select(ROW_ID, F.col("key_text").alias("line_key"))


def _two_keys(lines: DataFrame) -> DataFrame:
    """Failures of two unique columns and a rule on rows, by check."""
    keys = {"line": F.concat_ws("-", "l_orderkey", F.col("l_linenumber") % 5), "item": F.concat_ws("-", "l_partkey", "l_suppkey", "l_shipdate")}
    number = F.monotonically_increasing_id().alias(ROW_ID)
    table = lines.select(number, *[k.alias(name) for name, k in keys.items()], F.coalesce("l_returnflag", F.lit("")).alias("flag"))
    rules = [Rule("line", "unique"), Rule("flag", "known", lambda v: v.isin("A", "N")), Rule("item", "unique")]
    judged = judge(table, rules)
    summary = judged.summary.select(F.lit("any").alias("column"), F.lit("any").alias("check"), F.col("invalid_row_count").alias("failure_count"))
    return judged.failed_checks.unionByName(summary)


def _lines(raw: DataFrame, surplus: Column) -> DataFrame:
    """The rows as lines of a CSV with a header, with a field too many where ``surplus`` holds."""
    whole = F.to_csv(F.struct(COLUMNS), {**records.DIALECT, "emptyValue": "", "nullValue": ""})
    return raw.select(F.when(surplus, F.concat(whole, F.lit(",x"))).otherwise(whole).alias(",".join(COLUMNS)))


def _quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of rows that come in three drops, a run after each; the second holds malformed rows and a file of another kind."""
    raw, folder = _raw(spark, sf_dir), scratch_folder(spark)
    as_it_is = {"sep": "\u0001", "quote": "\u0002", "ignoreTrailingWhiteSpace": False, "header": True}
    for drop in range(3):
        rows = raw.where(F.col(ROW_ID) % 3 == drop)
        surplus = F.lit(drop == 1) & (F.col(ROW_ID) % 40 == 7)
        _lines(rows, surplus).write.mode("append").options(**as_it_is).csv(f"{folder}/in")
        if drop == 1:
            rows.limit(2).select(F.lit("1,2").alias("other,header")).coalesce(1).write.mode("append").options(**as_it_is).csv(f"{folder}/in")
        daily.validate_new_files(spark, f"{folder}/in", folder, customer_rules(AS_OF)).awaitTermination()
    return daily.judged_rows(spark, folder).select("customer_id", "email", "verdict", F.size("failed_checks").alias("failed"))


def _keys_over_days(raw: DataFrame) -> DataFrame:
    """Keys that came more than once over three days, each merged into what was counted before; one is sent twice."""
    history = KeyHistory(raw.sparkSession, scratch_folder(raw.sparkSession), buckets=8)
    for day in (0, 1, 2, 1):
        history.add(f"day {day}", raw.where(F.col(ROW_ID) % 3 == day), KEY)
    return history.repeated().select(F.col("key_text").alias(KEY), "row_count")


def _structural_failures(raw: DataFrame) -> DataFrame:
    """An absent column, one that is no text, and one with nulls."""
    rules = [r for r in customer_rules(AS_OF) if r.column in ("email", "phone", "income")]
    bent = raw.drop("phone").withColumns(
        {"income": F.col("income").try_cast("double"), "email": F.nullif("email", F.lit(""))}
    )
    return validate.failure_cases(bent, rules)


def _valid_table_verdict(raw: DataFrame) -> DataFrame:
    """The verdict on the rows that fail no check."""
    failed = validate.failure_cases(raw, customer_rules(AS_OF)).select(ROW_ID)
    return _summary(raw.join(failed, ROW_ID, "left_anti"))


def _written_report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every section of the quality report, written and read again."""
    report = profile.quality_report(tables.inferred_view(_raw(spark, sf_dir)), AS_OF)
    stored = tables.write_metrics(report, scratch_folder(spark))
    return reduce(
        DataFrame.unionByName,
        [t.agg(F.count("*").alias("row_count")).select(F.lit(s).alias("section"), "row_count") for s, t in stored.items()],
    )


def _generated_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must be true of generated customers, whatever is drawn."""
    made = _generated(spark, sf_dir)
    early = (F.col(ROW_ID) <= 25) & (F.col(ROW_ID) != 14)  # a faulty status may be blank as well
    others = [c for c in COLUMNS if c != KEY]
    blanks = sum((F.trim(c) == "").cast("int") for c in others)
    expected = F.col(ROW_ID).between(17, 25).cast("int")
    blank_at = F.array_position(F.array(*[F.trim(c) == "" for c in others]), True)
    last = made.orderBy(F.col(ROW_ID).desc()).limit(1).select(KEY).where(f"{KEY} <> ''")
    by_id = made.join(F.broadcast(last), KEY).agg((F.count("*") != 1).alias("holds"))
    income = F.col("income").try_cast("double")
    formed = F.col("phone").rlike("^\\d{3}-\\d{3}-\\d{4}$")
    held = made.agg(
        F.count("*").alias("rows"),
        (F.count_distinct(ROW_ID) == F.count("*")).alias("row_numbers_are_unique"),
        F.bool_and(~early | (blanks == expected)).alias("early_rows_lack_one_cell"),
        F.bool_and(~F.col(ROW_ID).between(17, 25) | (blank_at == F.col(ROW_ID) - 16)).alias("cells_go_missing_in_order"),
        F.bool_or((F.col(ROW_ID) == 12) & (income < 0)).alias("row_12_has_negative_income"),
        F.bool_or((F.col(ROW_ID) == 13) & (income > 10_000_000)).alias("row_13_has_too_much_income"),
        F.bool_or((F.col(ROW_ID) == 5) & (F.col("date_of_birth") == "invalid_date")).alias("row_5_has_no_date"),
        F.bool_or((F.col(ROW_ID) == 10) & (F.length("address") < 10)).alias("row_10_has_a_short_address"),
        F.bool_or((F.col(ROW_ID) == 11) & (F.length("address") > 200)).alias("row_11_has_a_long_address"),
        F.bool_and((F.col("income") == "") | income.isNotNull()).alias("income_is_a_number"),
        F.avg((~formed).cast("int")).between(0.1, 0.6).alias("some_phones_vary"),
        F.avg((blanks > 0).cast("int")).between(0.01, 0.2).alias("some_cells_are_missing"),
    )
    facts = [c for c in held.columns if c != "rows"]
    named = [F.struct(F.lit(c).alias("property"), F.col(c).alias("holds")) for c in facts]
    rows = held.select("rows", F.explode(F.array(*named)).alias("p")).select("p.property", "p.holds", "rows")
    repeats = by_id.select(F.lit("last_id_repeats_or_is_blank").alias("property"), "holds")
    return rows.unionByName(repeats.crossJoin(F.broadcast(held.select("rows"))))


def _job_failed_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored records of a job whose source lacks a column."""
    folder = scratch_folder(spark)
    try:
        run_job(spark, _raw(spark, sf_dir).drop("phone"), folder, AS_OF)
    except StageFailed:
        pass
    stages = spark.read.schema(RECORD).json(f"{folder}/execution/stages")
    run = spark.read.schema("status string, seconds double").json(f"{folder}/execution/run")
    record = stages.select("stage", "status", F.col("details")["row_count"].alias("row_count"), F.col("error").isNotNull().alias("has_error"))
    whole = run.select(F.lit("job").alias("stage"), "status", F.lit(None).cast("string").alias("row_count"), F.lit(False).alias("has_error"))
    return record.unionByName(whole)


def _job_stages_one_by_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage as a job of its own; only the first is given the source."""
    folder, source, reports = scratch_folder(spark), _raw(spark, sf_dir), []
    for name in STAGES:
        reports.append(run_job(spark, source, folder, AS_OF, stages=[name]))
        source = None
    stored = spark.read.schema(RECORD).json(f"{folder}/execution/stages")
    return stored.select("stage", F.explode("details").alias("metric", "value"))


def _job_dead_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is published after a stage died half-way: each row twice, written, then refused for repeated row numbers.

    A stage that runs after it reads the version before. Rows are those of the folder that the manifest names.
    """
    folder, source = scratch_folder(spark), _raw(spark, sf_dir)
    run_job(spark, source, folder, AS_OF, stages=["sense_raw_data", "validate_raw"])
    try:
        run_job(spark, source.unionAll(source), folder, AS_OF, row_id=ROW_ID, stages=["sense_raw_data"])
    except StageFailed:
        pass
    run_job(spark, None, folder, AS_OF, stages=["validate_raw", "clean_and_revalidate"])
    published = Published(spark, folder)
    counted = [
        spark.read.parquet(f"{published.last()[stage].place}/{name}").agg(F.count("*").alias("rows")).select(F.lit(stage).alias("stage"), "rows")
        for stage, name in (("sense_raw_data", "raw"), ("validate_raw", "validation/failures"), ("clean_and_revalidate", "cleaned"))
    ]
    rows = reduce(DataFrame.unionByName, counted)
    versions = published.manifest().groupBy("stage").agg(F.max("version").alias("version"))
    return versions.join(rows, "stage")


def _job_stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, its results written to the scratch folder; times are left out."""
    report = run_job(spark, _raw(spark, sf_dir), scratch_folder(spark), AS_OF)
    return report.frame(spark).select("stage", F.explode("details").alias("metric", "value"))


def _corpus():
    """The modules of the corpus operators, or None where they aren't installed."""
    try:
        import corpus_pipeline
        from veritide.llm import queries as corpus
    except ImportError:
        return None
    return corpus, corpus_pipeline


def queries() -> dict[str, Query]:
    own = _customer_queries()
    if found := _corpus():
        corpus, pipeline = found
        own |= corpus.queries() | {"pipeline": pipeline.run}
    return own


def _customer_queries() -> dict[str, Query]:
    return {
        # Sources
        "raw_scan": _on_raw(lambda raw: tables.customer_columns(raw)),
        "csv_round_trip": _csv_round_trip,
        "generated_customers": _generated,
        "csv_malformed_rows": _csv_malformed_rows,
        "csv_multiline": _csv_multiline,
        "csv_reordered_header": _csv_reordered_header,
        "csv_quoted_breaks": _csv_quoted_breaks,
        "generated_properties": _generated_properties,
        "generated_exact_repeats": _generated_exact_repeats,
        # Profile
        "completeness": _on_inferred(profile.completeness),
        "type_profile": _on_inferred(profile.type_profile),
        "format_issues": _on_inferred(profile.format_issues),
        "noncanonical_phone_sample": _on_inferred(profile.noncanonical_phones),
        "uniqueness": _on_inferred(profile.uniqueness),
        "duplicate_rows": _on_inferred(lambda seen: _repeated(seen, KEY)),
        "duplicate_id_sample": _on_inferred(profile.repeated_key_sample),
        "invalid_values": _on_inferred(lambda seen: profile.invalid_values(seen, AS_OF)),
        "status_counts": _on_inferred(profile.status_counts),
        "invalid_status": _on_inferred(profile.invalid_statuses),
        "invalid_status_rows": _on_inferred(profile.invalid_status_rows),
        "lineitem_completeness": _on("lineitem", profile.completeness),
        "lineitem_repeated_orders": _on("lineitem", lambda t: _repeated(t, "l_orderkey")),
        "orders_customer_uniqueness": _on("orders", lambda t: profile.uniqueness(t, "o_custkey")),
        "event_type_counts": _on(
            "events", lambda t: profile.value_counts(t, "event_type", EVENT_TYPES)
        ),
        "profile_over_days": _profile_over_days,
        "written_report_sections": _written_report_sections,
        # PII
        "pii_occurrences": _on_raw(pii.pii_occurrences),
        "pii_patterns": _on_raw(pii.pii_patterns),
        "breach_exposure": _on_raw(pii.breach_exposure),
        "text_pii_spans": _on("documents", lambda t: text_pii.text_spans(t, "doc_id", "text")),
        "text_pii_exposure": _on("documents", lambda t: text_pii.exposure(t, "text")),
        "text_masked": _on("documents", lambda t: text_pii.text_masked(t, "text").select("doc_id", "text")),
        "page_pii_spans": _on("pages", lambda t: text_pii.text_spans(t, "page_id", "html")),
        "page_masked": _on("pages", lambda t: text_pii.text_masked(t, "html").select("page_id", "html")),
        # Validation
        "row_checks": _on_raw(lambda raw: validate.row_checks(raw, customer_rules(AS_OF))),
        "failure_cases": _on_raw(lambda raw: validate.failure_cases(raw, customer_rules(AS_OF))),
        "failures_by_check": _on_raw(_failures_by_check),
        "validation_summary": _on_raw(_summary),
        "hot_key_repeats": _on("lineitem", _hot_key_repeats),
        "structural_failures": _on_raw(_structural_failures),
        "quarantine_stream": _quarantine_stream,
        "keys_over_days": _on_raw(_keys_over_days),
        "two_unique_columns": _on("lineitem", _two_keys),
        "valid_table_verdict": _on_raw(_valid_table_verdict),
        # Cleaning
        "normalize_phone": _on_raw(
            lambda raw: raw.select(
                ROW_ID,
                F.col("phone").alias("raw"),
                normalize_phone(F.col("phone")).alias("normalized"),
            )
        ),
        "normalize_date": _on_raw(_normalized_dates),
        "normalize_name": _on_raw(_normalized_names),
        "normalization_changes": _on_raw(clean.normalization_changes),
        "drop_fill_flag": _on_raw(_drop_fill_flag),
        "missing_value_log": _on_raw(lambda raw: clean.missing_log(clean.normalize_columns(raw))),
        "cleaned": _on_raw(clean.clean),
        "renumbered": _on_raw(lambda raw: dense_numbers(clean.clean(raw)).select(ROW_ID, KEY, "position")),
        "before_after_validation": _on_raw(lambda raw: _before_after(raw)[0]),
        "before_after_by_check": _on_raw(lambda raw: _before_after(raw)[1]),
        # Masking
        "mask_columns": _on_raw(lambda raw: mask.mask_table(raw).select(ROW_ID, *COLUMNS)),
        "masked_sample": _on_raw(lambda raw: mask.masked_sample(clean.clean(raw))),
        "full_masked_output": _on_raw(lambda raw: mask.mask_table(clean.clean(raw))),
        # Job
        "job_stage_metrics": _job_stage_metrics,
        "job_stages_one_by_one": _job_stages_one_by_one,
        "job_failed_stage": _job_failed_stage,
        "job_dead_attempt": _job_dead_attempt,
    }


def oracle_sql() -> dict[str, str]:
    own = oracles.all_oracles()
    if found := _corpus():
        corpus, pipeline = found
        own |= corpus.oracle_sql() | ({"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {})
    return own
