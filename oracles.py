"""DuckDB SQL for the queries of ``__spark_entry__``, written apart from the library.

Each oracle that reads customers starts from the same messy rows as its query.
"""

from __future__ import annotations

from veritide.contract import COLUMNS
from veritide.sources import faults
from veritide.sources.messy_customers import MESSY_CUSTOMERS

AS_OF = "DATE '2026-01-01'"
DATES = ("date_of_birth", "created_date")
NA = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
EMAIL = r"'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'"
PHONE = r"'^\+?1?[\s.-]?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}$'"
CANONICAL = r"'^\d{3}-\d{3}-\d{4}$'"
NAME = "'^[A-Za-z]+(?:[ ''-][A-Za-z]+)*$'"
ISO = r"'^\d{4}-\d{2}-\d{2}$'"


def present(c: str) -> str:
    return f"(trim({c}) <> '')"


def iso_day(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"


def age(c: str) -> str:
    return f"(date_diff('day', {iso_day(c)}, {AS_OF}) / 365.25)"


def pct(part: str, whole: str) -> str:
    return f"round(100.0 * {part} / {whole}, 2)"


# --- Rules --------------------------------------------------------------------------------------

RULES = {
    ("customer_id", "positive_integer"): (
        "coalesce(try_cast(customer_id AS DOUBLE) % 1 = 0 AND try_cast(customer_id AS DOUBLE) > 0,"
        " false)"
    ),
    ("customer_id", "unique"): "customer_id NOT IN (SELECT customer_id FROM TABLE WHERE "
    "trim(customer_id) <> '' GROUP BY customer_id HAVING count(*) > 1)",
    **{
        (c, "valid_name"): f"regexp_matches({c}, {NAME}) AND length({c}) BETWEEN 2 AND 50"
        for c in ("first_name", "last_name")
    },
    ("email", "valid_email"): f"regexp_matches(email, {EMAIL})",
    ("phone", "valid_phone"): f"regexp_matches(phone, {PHONE})",
    **{
        (c, "valid_date_format"): f"{iso_day(c)} IS NOT NULL"
        for c in ("date_of_birth", "created_date")
    },
    ("date_of_birth", "plausible_age"): (
        f"coalesce({age('date_of_birth')} BETWEEN 0 AND 150, false)"
    ),
    ("address", "valid_length"): "length(address) BETWEEN 10 AND 200",
    ("income", "in_range"): "coalesce(try_cast(income AS DOUBLE) BETWEEN 0 AND 10000000, false)",
    ("account_status", "valid_status"): "account_status IN ('active', 'inactive', 'suspended')",
}


def checks(table: str) -> dict[tuple[str, str], str]:
    """The verdict of each rule over ``table``."""
    verdicts = {(c, "required"): present(c) for c in COLUMNS}
    for (c, check), holds in RULES.items():
        verdicts[(c, check)] = f"(NOT {present(c)} OR ({holds.replace("TABLE", table)}))"
    return verdicts


def cases(table: str) -> str:
    return " UNION ALL ".join(
        f'SELECT row_id, \'{c}\' AS "column", \'{check}\' AS "check", {c} AS failure_case '
        f"FROM {table} WHERE NOT {holds}"
        for (c, check), holds in checks(table).items()
    )


def summary(table: str) -> str:
    return f"""
      SELECT row_count, invalid_row_count,
             {pct('invalid_row_count', 'row_count')} AS invalid_pct,
             invalid_row_count = 0 AS is_valid
      FROM (SELECT (SELECT count(*) FROM {table}) AS row_count,
                   (SELECT count(DISTINCT row_id) FROM ({cases(table)})) AS invalid_row_count)"""


# --- Normalised, cleaned, masked ----------------------------------------------------------------


def title(c: str) -> str:
    runs = rf"regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+')"
    return f"list_aggregate(list_transform({runs}, lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '')"


def any_day(c: str) -> str:
    formats = ", ".join(
        f"try_strptime({c}, '{f}')" for f in ("%Y-%m-%d", "%m/%d/%Y", "%d-%b-%Y", "%d/%m/%Y")
    )
    return f"coalesce(strftime(coalesce({formats}), '%Y-%m-%d'), {c})"


def national(c: str) -> str:
    digits = rf"regexp_replace({c}, '\D', '', 'g')"
    return f"CASE WHEN length({digits}) = 11 AND {digits} LIKE '1%' THEN substr({digits}, 2) ELSE {digits} END"


PHONE_NORMAL = (
    "CASE WHEN length(n) = 10 THEN substr(n, 1, 3) || '-' || substr(n, 4, 3) || '-' || substr(n, 7)"
    " ELSE phone END"
)
NORMALIZED = f"""
normalized AS (
  SELECT row_id, customer_id,
    CASE WHEN {present('first_name')} THEN {title('first_name')} ELSE first_name END AS first_name,
    CASE WHEN {present('last_name')} THEN {title('last_name')} ELSE last_name END AS last_name,
    email, {PHONE_NORMAL} AS phone, {any_day('date_of_birth')} AS date_of_birth, address, income,
    account_status, {any_day('created_date')} AS created_date
  FROM (SELECT *, {national('phone')} AS n FROM customers_raw)
)"""
CLEANED = """
cleaned AS (
  SELECT row_id, customer_id,
    CASE WHEN trim(first_name) = '' THEN 'Unknown' ELSE first_name END AS first_name,
    CASE WHEN trim(last_name) = '' THEN 'Unknown' ELSE last_name END AS last_name,
    email, phone, date_of_birth, address, income,
    CASE WHEN trim(account_status) = '' THEN 'unknown' ELSE account_status END AS account_status,
    created_date
  FROM normalized WHERE trim(customer_id) <> ''
)"""


def masks() -> dict[str, str]:
    name = "CASE WHEN trim({c}) = '' THEN {c} ELSE substr({c}, 1, 1) || '***' END"
    return {
        "first_name": name.format(c="first_name"),
        "last_name": name.format(c="last_name"),
        "email": "CASE WHEN trim(email) = '' THEN email WHEN strpos(email, '@') > 1 "
        "THEN substr(email, 1, 1) || '***' || substr(email, strpos(email, '@')) ELSE '***' END",
        "phone": rf"""CASE WHEN trim(phone) = '' THEN phone
          WHEN regexp_matches(phone, {CANONICAL}) THEN '***-***-' || right(phone, 4)
          WHEN length(regexp_replace(phone, '\D', '', 'g')) >= 4
          THEN '***' || right(regexp_replace(phone, '\D', '', 'g'), 4) ELSE '***' END""",
        "date_of_birth": f"""CASE WHEN trim(date_of_birth) = '' THEN date_of_birth
          WHEN regexp_matches(date_of_birth, {ISO}) THEN substr(date_of_birth, 1, 4) || '-**-**'
          ELSE '****-**-**' END""",
        "address": "CASE WHEN trim(address) = '' THEN address ELSE '[MASKED ADDRESS]' END",
    }


def masked(table: str) -> str:
    cells = ", ".join(f"{masks()[c]} AS {c}" if c in masks() else c for c in COLUMNS)
    return f"SELECT row_id, {cells} FROM {table}"


# --- Generated customers ------------------------------------------------------------------------


def draw(row: str, purpose: str, seed: int) -> str:
    f, o = faults.draw_constants(purpose, seed)
    p = faults.PRIME
    one = f"(({row} % {p} * {f} + {o}) % {p})"
    two = f"(({one} * {one} + {f}) % {p})"
    return f"(({two} * {two} + {o}) % {p})"


def pick(values: list[str], place: str) -> str:
    texts = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{texts}])[{place} % {len(values)} + 1]"


def money(low: int, high: int, place: str) -> str:
    cents = f"({low * 100} + {place} % {(high - low) * 100 + 1})"
    return f"(({cents} // 100) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'))"


def layouts(phone: str, place: str) -> str:
    digits = f"""CASE WHEN regexp_replace({phone}, '[^0-9]', '', 'g') = '' THEN area || exchange || line
      ELSE regexp_replace({phone}, '[^0-9]', '', 'g') END"""
    a, e, n = (f"substr({digits}, {i}, {k})" for i, k in ((1, 3), (4, 3), (7, 4)))
    return f"""CASE {place} % 5 WHEN 0 THEN '(' || {a} || ') ' || {e} || '-' || {n}
      WHEN 1 THEN {a} || '.' || {e} || '.' || {n} WHEN 2 THEN {a} || {e} || {n}
      WHEN 3 THEN '+1-' || {a} || '-' || {e} || '-' || {n} ELSE '+1 ' || {a} || ' ' || {e} || ' ' || {n} END"""


def fault(row: str, seed: int, rate: float) -> str:
    return f"""CASE WHEN {row} <= 25 THEN {row}
      WHEN {draw(row, 'has_fault', seed)} < {int(rate * faults.PRIME)}
      THEN {draw(row, 'fault', seed)} % 25 + 1 ELSE 0 END"""


def generated(seed: int = 42) -> str:
    """Every cell of the generated customers, whose fault numbers are 1 to 25."""
    drawn = ", ".join(f"{draw('row_id', p, seed)} AS d_{p}" for p in faults.PURPOSES)

    def other(day: str) -> str:
        formats = ("%m/%d/%Y", "%d-%b-%Y", "%d/%m/%Y")
        texts = ", ".join(f"strftime({day}, '{f}')" for f in formats)
        return f"([{texts}])[d_sample % 3 + 1]"

    name, days = pick(faults.INVALID_NAMES, "d_sample"), "CAST(30 + d_days % 3621 AS INT)"
    return f"""
    WITH ids AS (
      SELECT CAST(c_custkey AS BIGINT) + 1 AS row_id, count(*) OVER () AS n FROM customer
    ),
    drawn AS (SELECT row_id, n, {drawn} FROM ids),
    based AS (
      SELECT *, {fault('row_id', seed, 0.15)} AS f, d_source % (n - 1) + 1 AS source,
        {AS_OF} - CAST(6588 + d_birth % (32850 - 6588 + 1) AS INT) AS birth,
        {pick(faults.FIRST_NAMES, 'd_first_name')} AS fn,
        {pick(faults.LAST_NAMES, 'd_last_name')} AS ln,
        CAST(200 + d_area % 800 AS VARCHAR) AS area,
        CAST(200 + d_exchange % 800 AS VARCHAR) AS exchange,
        CAST(1000 + d_line % 9000 AS VARCHAR) AS line
      FROM drawn
    ),
    clean AS (
      SELECT *, birth + 6570
          + CAST(d_created % (date_diff('day', birth + 6570, {AS_OF}) + 1) AS INT) AS created,
        area || '-' || exchange || '-' || line AS ph,
        CAST(1 + d_house % 999 AS VARCHAR) || ' ' || {pick(faults.STREETS, 'd_street')} || ', '
          || {pick(faults.TOWNS, 'd_town')} AS ad
      FROM based
    ),
    faulty AS (
      SELECT *, CASE f WHEN 3 THEN {pick(faults.INVALID_PHONES, 'd_sample')}
                       WHEN 4 THEN {layouts('ph', 'd_layout')} WHEN 20 THEN '' ELSE ph END AS ph2
      FROM clean
    )
    SELECT row_id,
      CASE WHEN d_duplicate < {int(0.02 * faults.PRIME)} OR row_id = n
           THEN CASE WHEN {fault('source', seed, 0.15)} = 16 THEN '' ELSE CAST(source AS VARCHAR) END
           WHEN f = 16 THEN '' ELSE CAST(row_id AS VARCHAR) END AS customer_id,
      CASE WHEN f = 17 THEN '' WHEN f = 1 AND d_name_column % 2 = 0 THEN {name} ELSE fn END AS first_name,
      CASE WHEN f = 18 THEN '' WHEN f = 1 AND d_name_column % 2 = 1 THEN {name} ELSE ln END AS last_name,
      CASE f WHEN 19 THEN '' WHEN 2 THEN {pick(faults.INVALID_EMAILS, 'd_sample')}
        ELSE lower(fn) || '.' || lower(ln) || '@' || {pick(faults.MAIL_DOMAINS, 'd_domain')} END AS email,
      CASE WHEN row_id > 25 AND d_varies < {int(0.3 * faults.PRIME)}
           THEN {layouts('ph2', 'd_second_layout')} ELSE ph2 END AS phone,
      CASE f WHEN 21 THEN '' WHEN 5 THEN 'invalid_date'
        WHEN 6 THEN CAST(2026 - (151 + d_days % 50) AS VARCHAR) || '-01-15'
        WHEN 7 THEN strftime({AS_OF} + {days}, '%Y-%m-%d') WHEN 8 THEN {other('birth')}
        ELSE strftime(birth, '%Y-%m-%d') END AS date_of_birth,
      CASE f WHEN 22 THEN '' WHEN 10 THEN {pick(faults.SHORT_ADDRESSES, 'd_sample')}
        WHEN 11 THEN repeat(ad || ' ', 10) ELSE ad END AS address,
      CASE f WHEN 23 THEN '' WHEN 12 THEN '-' || {money(1000, 50000, 'd_sample')}
        WHEN 13 THEN {money(10000001, 20000000, 'd_sample')}
        ELSE {money(20000, 250000, 'd_income')} END AS income,
      CASE f WHEN 24 THEN '' WHEN 14 THEN {pick(faults.INVALID_STATUSES, 'd_sample')}
        ELSE {pick(['active', 'inactive', 'suspended'], 'd_status')} END AS account_status,
      CASE f WHEN 25 THEN '' WHEN 9 THEN {other('created')}
        WHEN 15 THEN strftime(birth - {days}, '%Y-%m-%d')
        ELSE strftime(created, '%Y-%m-%d') END AS created_date
    FROM faulty"""


#: What holds for generated customers however they are drawn.
PROPERTIES = [
    "row_numbers_are_unique", "early_rows_lack_one_cell", "cells_go_missing_in_order",
    "row_12_has_negative_income", "row_13_has_too_much_income", "row_5_has_no_date",
    "row_10_has_a_short_address", "row_11_has_a_long_address", "income_is_a_number",
    "some_phones_vary", "some_cells_are_missing", "last_id_repeats_or_is_blank",
]


# --- All oracles --------------------------------------------------------------------------------


def rows(names: str, *entries: str, table: str) -> str:
    """``SELECT`` each entry over the table, one below the other."""
    names = names.split()
    selects = []
    for entry in entries:
        cells = [cell.strip() for cell in entry.split("|")]
        named = ", ".join(f'{cell} AS "{n}"' for cell, n in zip(cells, names))
        selects.append(f"SELECT {named} FROM {table}")
    return " UNION ALL ".join(selects)


def _profile() -> dict[str, str]:
    def n(condition: str) -> str:
        return f"count(*) FILTER (WHERE {condition})"

    def dtype(c: str) -> str:
        full = f"count({c}) = count(*)"
        return f"""CASE WHEN count({c}) = 0 THEN 'float64'
          WHEN {full} AND bool_and(regexp_matches({c}, '^[+-]?[0-9]+$')) THEN 'int64'
          WHEN bool_and(try_cast({c} AS DOUBLE) IS NOT NULL) FILTER (WHERE {c} IS NOT NULL) THEN 'float64'
          ELSE 'object' END"""

    expected = {
        "customer_id": "integer", "first_name": "string", "last_name": "string",
        "email": "string (email format)", "phone": "string (phone format)",
        "date_of_birth": "date (YYYY-MM-DD)", "address": "string", "income": "numeric",
        "account_status": "categorical", "created_date": "date (YYYY-MM-DD)",
    }

    def fits(c: str) -> str:
        if expected[c] in ("integer", "numeric"):
            return f"({dtype(c)}) IN ('int64', 'float64')"
        if expected[c].startswith("date"):
            return f"bool_and({iso_day(c)} IS NOT NULL) FILTER (WHERE {c} IS NOT NULL)"
        return f"({dtype(c)}) = 'object'"

    income, key = "try_cast(income AS DOUBLE)", "try_cast(customer_id AS DOUBLE)"

    def literal(c: str) -> str:
        return f"{c} = 'invalid_date'"

    def odd(c: str) -> str:
        return f"{c} <> 'invalid_date' AND NOT regexp_matches({c}, {ISO})"

    keys = f"SELECT {key} AS v, count(*) AS c, min(customer_id) AS text FROM seen WHERE customer_id IS NOT NULL GROUP BY 1"
    sections = {
        "completeness": "completeness", "types": "type_profile", "format_issues": "format_issues",
        "noncanonical_phones": "noncanonical_phone_sample", "uniqueness": "uniqueness",
        "repeated_key_sample": "duplicate_id_sample", "invalid_values": "invalid_values",
        "status_counts": "status_counts", "invalid_statuses": "invalid_status",
    }
    status = "SELECT coalesce(account_status, 'nan') AS account_status, count(*) AS row_count, coalesce(account_status IN ('active', 'inactive', 'suspended'), false) AS is_valid FROM seen GROUP BY account_status"
    found = {
        "completeness": rows(
            "column missing_count missing_pct",
            *[f"'{c}' | {n(c + ' IS NULL')} | {pct(n(c + ' IS NULL'), 'count(*)')}" for c in COLUMNS],
            table="seen",
        ),
        "profile_over_days": rows(
            "column row_count missing_count missing_pct within_error",
            *[f"'{c}' | count(*) | {n(c + ' IS NULL')} | {pct(n(c + ' IS NULL'), 'count(*)')} | true" for c in COLUMNS],
            table="seen",
        ),
        "type_profile": rows(
            "column expected_type actual_dtype matches_expected",
            *[f"'{c}' | '{expected[c]}' | {dtype(c)} | {fits(c)}" for c in COLUMNS],
            table="seen",
        ),
        "format_issues": rows(
            "issue column row_count",
            f"'non_canonical' | 'phone' | {n(f'NOT regexp_matches(phone, {CANONICAL})')}",
            *[f"'non_iso' | '{c}' | {n(odd(c))}" for c in DATES],
            table="seen",
        ),
        "noncanonical_phone_sample": f"SELECT row_id, phone FROM seen WHERE NOT regexp_matches(phone, {CANONICAL}) ORDER BY row_id LIMIT 5",
        "uniqueness": f"""SELECT (SELECT count(*) FROM seen) AS total_rows, count(*) AS unique_keys,
            CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS duplicate_rows FROM ({keys})""",
        "duplicate_rows": f"SELECT text AS customer_id, c AS row_count FROM ({keys}) WHERE c > 1",
        "duplicate_id_sample": f"SELECT text AS customer_id, c AS row_count FROM ({keys}) WHERE c > 1 ORDER BY v LIMIT 10",
        "invalid_values": rows(
            "issue column row_count",
            f"'negative' | 'income' | {n(income + ' < 0')}",
            f"'over_max' | 'income' | {n(income + ' > 10000000')}",
            *[f"'invalid_date_literal' | '{c}' | {n(literal(c))}" for c in DATES],
            f"'age_over_max' | 'date_of_birth' | {n(age('date_of_birth') + ' > 150')}",
            f"'age_negative' | 'date_of_birth' | {n(age('date_of_birth') + ' < 0')}",
            f"'non_positive' | 'customer_id' | {n(key + ' <= 0')}",
            table="seen",
        ),
        "status_counts": status,
        "invalid_status": f"SELECT account_status, row_count FROM ({status}) WHERE NOT is_valid",
        "invalid_status_rows": f"SELECT CAST(sum(row_count) AS BIGINT) AS invalid_row_count FROM ({status}) WHERE NOT is_valid",
    }
    return found | {
        "written_report_sections": " UNION ALL ".join(
            f"SELECT '{section}' AS section, count(*) AS row_count FROM ({found[query]})"
            for section, query in sections.items()
        )
    }


def _customers() -> dict[str, str]:
    """Oracles over ``customers_raw``, ``normalized`` and ``cleaned``."""
    categories = {
        "name": ("Medium", ["first_name", "last_name"]),
        "contact_info": ("High", ["email", "phone"]),
        "sensitive_personal": ("High", ["date_of_birth", "address"]),
        "financial": ("Medium", ["income"]),
    }

    def n(condition: str) -> str:
        return f"count(*) FILTER (WHERE {condition})"

    def pattern(c: str, regex: str) -> str:
        there, fits = n(present(c)), n(f"{present(c)} AND regexp_matches({c}, {regex})")
        return f"'{c}' | {there} | {fits} | {there} - {fits}"

    identity = " AND ".join(
        present(c) for c in "first_name last_name email phone date_of_birth address".split()
    )
    by_check = """SELECT "column", "check", count(*) AS {n} FROM ({cases}) GROUP BY ALL"""
    samples = f"""
      SELECT "column", "check", count(*) AS failure_count,
             string_agg(CAST(row_id AS VARCHAR), ',' ORDER BY row_id) FILTER (WHERE place <= 5)
               AS sample_row_ids
      FROM (SELECT *, row_number() OVER (PARTITION BY "column", "check" ORDER BY row_id) AS place
            FROM ({cases('customers_raw')})) GROUP BY ALL"""
    fill, flag = ("first_name", "last_name", "account_status"), (
        "email", "phone", "date_of_birth", "address", "income", "created_date",
    )
    kept = present("customer_id")
    blanks = ", ".join(f"CASE WHEN trim({c}) = '' THEN '{c}' END" for c in flag)
    changed = "first_name last_name phone date_of_birth created_date".split()
    shown = " UNION ALL ".join(
        f"SELECT row_id, customer_id, '{c}' AS \"column\", {c} AS before, {mask} AS after FROM first_rows"
        for c, mask in masks().items()
    )
    every = ", ".join(
        f'{holds} AS "{c}__{check}"' for (c, check), holds in checks("customers_raw").items()
    )

    failed_rules = " + ".join(
        f"CAST(NOT ({holds}) AS INTEGER)" for (_, check), holds in checks("customers_raw").items() if check != "unique"
    )

    def stage(name: str, metric: str, value: str) -> str:
        return f"SELECT '{name}' AS stage, '{metric}' AS metric, CAST(({value}) AS VARCHAR) AS value"

    def recorded(name: str, status: str, row_count: str = "NULL", has_error: bool = False) -> str:
        return f"SELECT '{name}' AS stage, '{status}' AS status, CAST(({row_count}) AS VARCHAR) AS row_count, {has_error} AS has_error"

    repeated = "SELECT count(*) AS c FROM customers_raw WHERE trim(customer_id) <> '' GROUP BY customer_id HAVING count(*) > 1"
    invalid = "SELECT count(DISTINCT row_id) FROM ({})"
    metrics = " UNION ALL ".join(
        [
            stage("sense_raw_data", "row_count", "SELECT count(*) FROM customers_raw"),
            stage("profile_quality", "row_count", "SELECT count(*) FROM customers_raw"),
            stage("profile_quality", "duplicate_id_rows", f"SELECT CAST(sum(c) AS BIGINT) FROM ({repeated})"),
            stage(
                "profile_quality",
                "invalid_account_status_rows",
                "SELECT count(*) FROM customers_raw WHERE account_status NOT IN ('active', 'inactive', 'suspended')",
            ),
            stage("detect_pii", "full_identity_profile_rows", f"SELECT {n(identity)} FROM customers_raw"),
            stage("validate_raw", "invalid_row_count", invalid.format(cases("customers_raw"))),
            stage("validate_raw", "row_count", "SELECT count(*) FROM customers_raw"),
            stage("clean_and_revalidate", "rows_out", "SELECT count(*) FROM cleaned"),
            stage("clean_and_revalidate", "post_clean_invalid_row_count", invalid.format(cases("cleaned"))),
            stage("mask_pii", "rows_masked", "SELECT count(*) FROM cleaned"),
        ]
    )
    return {
        "raw_scan": "SELECT * FROM customers_raw",
        "csv_round_trip": "SELECT * EXCLUDE row_id FROM customers_raw",
        "pii_occurrences": rows(
            "category risk_level column populated_count category_total",
            *[
                f"'{category}' | '{risk}' | '{c}' | {n(present(c))} | "
                + " + ".join(n(present(other)) for other in columns)
                for category, (risk, columns) in categories.items()
                for c in columns
            ],
            table="customers_raw",
        ),
        "pii_patterns": rows(
            "column populated_count matching_count non_matching_count",
            pattern("email", EMAIL),
            pattern("phone", PHONE),
            table="customers_raw",
        ),
        "breach_exposure": f"""SELECT count(*) AS total_records, {n(identity)} AS full_profile_count,
            {pct(n(identity), 'count(*)')} AS full_profile_pct FROM customers_raw""",
        "row_checks": f"SELECT row_id, {every} FROM customers_raw",
        "failure_cases": cases("customers_raw"),
        "failures_by_check": samples,
        "validation_summary": summary("customers_raw"),
        "normalize_phone": "SELECT r.row_id, r.phone AS raw, n.phone AS normalized FROM customers_raw r JOIN normalized n USING (row_id)",
        "normalize_date": "SELECT r.row_id, r.date_of_birth AS raw_birth, n.date_of_birth AS birth, r.created_date AS raw_created, n.created_date AS created FROM customers_raw r JOIN normalized n USING (row_id)",
        "normalize_name": "SELECT r.row_id, r.first_name AS raw_first, n.first_name AS first, r.last_name AS raw_last, n.last_name AS last FROM customers_raw r JOIN normalized n USING (row_id)",
        "normalization_changes": rows(
            "column n_changed",
            *[f"'{c}' | {n(f'r.{c} <> n.{c}')}" for c in changed],
            table="customers_raw r JOIN normalized n USING (row_id)",
        ),
        "drop_fill_flag": f"""SELECT c.*, array_to_string(list_filter([{blanks}], lambda b: b IS NOT NULL), ',')
            AS review_columns FROM cleaned c""",
        "missing_value_log": "SELECT * FROM ("
        + rows(
            "action column n",
            f"'drop' | 'customer_id' | {n('NOT ' + kept)}",
            *[f"'placeholder' | '{c}' | {n(f'{kept} AND NOT {present(c)}')}" for c in fill],
            *[f"'flag' | '{c}' | {n(f'{kept} AND NOT {present(c)}')}" for c in flag],
            table="customers_raw",
        )
        + ") WHERE n > 0",
        "cleaned": "SELECT * FROM cleaned",
        "before_after_validation": f"""SELECT 'before' AS phase, * FROM ({summary('customers_raw')})
            UNION ALL SELECT 'after' AS phase, * FROM ({summary('cleaned')})""",
        "before_after_by_check": f"""SELECT "column", "check", coalesce(before_count, 0) AS before_count,
            coalesce(after_count, 0) AS after_count
            FROM ({by_check.format(n='before_count', cases=cases('customers_raw'))}) b
            FULL JOIN ({by_check.format(n='after_count', cases=cases('cleaned'))}) a
            USING ("column", "check")""",
        "mask_columns": masked("customers_raw"),
        "masked_sample": f"WITH first_rows AS (SELECT * FROM cleaned ORDER BY row_id LIMIT 10) {shown}",
        "full_masked_output": masked("cleaned"),
        "job_stage_metrics": metrics,
        "job_stages_one_by_one": metrics,
        "job_failed_stage": " UNION ALL ".join(
            [
                recorded("sense_raw_data", "SUCCESS", "SELECT count(*) FROM customers_raw"),
                recorded("profile_quality", "FAILED", has_error=True),
                recorded("job", "FAILED"),
            ]
        ),
        "job_dead_attempt": f"""SELECT 'sense_raw_data' AS stage, 1::BIGINT AS version, (SELECT count(*) FROM customers_raw) AS rows
            UNION ALL SELECT 'validate_raw', 2, (SELECT count(*) FROM ({cases('customers_raw')}))
            UNION ALL SELECT 'clean_and_revalidate', 1, (SELECT count(*) FROM cleaned)""",
        "csv_malformed_rows": """SELECT customer_id, email, row_id % 40 = 7 OR row_id % 50 = 9 AS malformed
            FROM customers_raw""",
        "csv_multiline": "SELECT * EXCLUDE row_id REPLACE (address || chr(10) || 'Floor 2' AS address) FROM customers_raw",
        "quarantine_stream": f"""SELECT customer_id, email, CASE WHEN failed = 0 AND NOT malformed THEN 'accepted' ELSE 'quarantined' END AS verdict,
              CAST(failed AS INTEGER) AS failed
            FROM (SELECT *, row_id % 3 = 1 AND row_id % 40 = 7 AS malformed, {failed_rules} AS failed FROM customers_raw)
            UNION ALL SELECT '', '', 'quarantined', 10 FROM (SELECT 1 FROM customers_raw WHERE row_id % 3 = 1 LIMIT 2)""",
        "keys_over_days": """SELECT customer_id, count(*) AS row_count FROM customers_raw WHERE trim(customer_id) <> ''
            GROUP BY customer_id HAVING count(*) > 1""",
        "renumbered": """SELECT row_id, customer_id, row_number() OVER (ORDER BY row_id) - 1 AS position FROM cleaned""",
        "csv_reordered_header": "SELECT * EXCLUDE row_id FROM customers_raw",
        "csv_quoted_breaks": """SELECT * EXCLUDE row_id REPLACE ('"The" ' || address || chr(10) || 'Floor "2"' || chr(10) AS address)
            FROM customers_raw""",
        "structural_failures": f"""SELECT CAST(NULL AS BIGINT) AS row_id, 'phone' AS "column",
              'column_in_table' AS "check", 'phone' AS failure_case
            UNION ALL SELECT NULL, 'income', 'dtype', 'double'
            UNION ALL SELECT row_id, 'email', 'not_null', NULL FROM customers_raw WHERE email = ''
            UNION ALL SELECT row_id, 'email', 'valid_email', email FROM customers_raw
            WHERE email <> '' AND NOT regexp_matches(email, {EMAIL})""",
        "valid_table_verdict": f"""SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS invalid_row_count,
            CAST(0 AS DOUBLE) AS invalid_pct, true AS is_valid FROM customers_raw
            WHERE row_id NOT IN (SELECT row_id FROM ({cases('customers_raw')}))""",
    }


def _supplied_tables() -> dict[str, str]:
    lineitem = (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
        "l_returnflag l_linestatus l_shipdate"
    ).split()
    return {
        "lineitem_completeness": rows(
            "column missing_count missing_pct",
            *[f"'{c}' | count(*) - count({c}) | {pct(f'(count(*) - count({c}))', 'count(*)')}" for c in lineitem],
            table="lineitem",
        ),
        "orders_customer_uniqueness": """SELECT CAST(sum(c) AS BIGINT) AS total_rows, count(*) AS unique_keys,
            CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS duplicate_rows
            FROM (SELECT o_custkey, count(*) AS c FROM orders GROUP BY 1)""",
        "lineitem_repeated_orders": """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, count(*) AS row_count
            FROM lineitem GROUP BY lineitem.l_orderkey HAVING count(*) > 1""",
        "event_type_counts": """SELECT coalesce(event_type, 'nan') AS event_type, count(*) AS row_count,
            coalesce(event_type IN ('click', 'view', 'purchase'), false) AS is_valid
            FROM events GROUP BY events.event_type""",
        "generated_customers": generated(),
        "generated_exact_repeats": """SELECT CAST(r AS DOUBLE) AS rate, n AS rows, greatest(1, CAST(round_even(n * r, 0) AS BIGINT)) AS repeats
            FROM (SELECT count(*) AS n FROM customer), (VALUES (0.02), (0.1), (0.3)) rates(r)""",
        "generated_properties": "SELECT p.property, true AS holds, n.rows FROM (VALUES "
        + ", ".join(f"('{p}')" for p in PROPERTIES)
        + ") p(property), (SELECT count(*) AS rows FROM customer) n",
        "two_unique_columns": """WITH t AS (SELECT *, l_orderkey || '-' || l_linenumber % 5 AS line,
              l_partkey || '-' || l_suppkey || '-' || CAST(l_shipdate AS DATE) AS item FROM lineitem),
            judged AS (SELECT count(*) OVER (PARTITION BY line) > 1 AS line_fails, count(*) OVER (PARTITION BY item) > 1 AS item_fails,
              coalesce(l_returnflag, '') NOT IN ('', 'A', 'N') AS flag_fails FROM t)
            SELECT * FROM (SELECT 'line' AS "column", 'unique' AS "check", count_if(line_fails) AS failure_count FROM judged
            UNION ALL SELECT 'item', 'unique', count_if(item_fails) FROM judged
            UNION ALL SELECT 'flag', 'known', count_if(flag_fails) FROM judged
            UNION ALL SELECT 'any', 'any', count_if(line_fails OR item_fails OR flag_fails) FROM judged) WHERE failure_count > 0""",
        "hot_key_repeats": """WITH lines AS (
            SELECT CAST(l_orderkey AS BIGINT) * 100 + l_linenumber AS row_id,
              CASE WHEN l_linenumber % 3 = 1 THEN 'hot' ELSE l_partkey || '-' || l_suppkey END AS line_key
            FROM lineitem)
          SELECT * FROM lines WHERE line_key IN (SELECT line_key FROM lines GROUP BY 1 HAVING count(*) > 1)""",
    }


# --- Emails and phone numbers in text ------------------------------------------------------------

#: DuckDB's patterns can't look around, so every run of digits gets a mark before and one after it.
BEFORE, AFTER = "\x01", "\x02"
IN_TEXT = (
    rf"[A-Za-z0-9._%+{BEFORE}{AFTER}-]+@[A-Za-z0-9.{BEFORE}{AFTER}-]+\.[A-Za-z]{{2,}}"
    rf"|(?:\+?{BEFORE}1{AFTER}?[\s.-]?\(?{BEFORE}?|\(?{BEFORE})[0-9]{{3}}{AFTER}?\)?[\s.-]?{BEFORE}?[0-9]{{3}}{AFTER}?[\s.-]?{BEFORE}?[0-9]{{4}}{AFTER}"
)


def _in_text(table: str, key: str, column: str) -> dict[str, str]:
    """SQL of the spans, the exposure and the masked text of a column."""

    def plain(x: str) -> str:
        return f"translate({x}, '{BEFORE}{AFTER}', '')"

    digits = "regexp_replace(f, '[^0-9]', '', 'g')"
    hidden = f"""CASE WHEN contains(f, '@') THEN left(f, 1) || '***' || substr(f, instr(f, '@'))
        WHEN regexp_matches(f, {CANONICAL}) THEN '***-***-' || right(f, 4) ELSE '***' || right({digits}, 4) END"""
    cut = f"""WITH marked AS (SELECT {key} AS key, {column} AS own,
          regexp_replace(coalesce({column}, ''), '([0-9]+)', '{BEFORE}\\1{AFTER}', 'g') AS body FROM {table}),
        cut AS (SELECT key, own, list_transform(regexp_extract_all(body, '{IN_TEXT}'), lambda x: {plain('x')}) AS found,
          list_transform(string_split_regex(body, '{IN_TEXT}'), lambda x: {plain('x')}) AS gaps FROM marked),
        hits AS (SELECT key, unnest(range(1, len(found) + 1)) AS i, found, gaps FROM cut),
        placed AS (SELECT key, found[i] AS found, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS INTEGER) AS start FROM hits),
        spans AS (SELECT key, CASE WHEN contains(found, '@') THEN 'email' ELSE 'phone' END AS kind, start,
          CAST(start + length(found) AS INTEGER) AS stop, found FROM placed)"""
    return {
        "spans": f"{cut} SELECT key AS {key}, kind, start, stop, found FROM spans",
        "exposure": f"""{cut} SELECT (SELECT count(*) FROM {table}) AS texts,
            count(DISTINCT key) FILTER (WHERE kind = 'email') AS with_email, count(DISTINCT key) FILTER (WHERE kind = 'phone') AS with_phone,
            count(DISTINCT key) AS with_any, count_if(kind = 'email') AS emails, count_if(kind = 'phone') AS phones FROM spans""",
        "masked": f"""{cut} SELECT key AS {key}, CASE WHEN own IS NOT NULL THEN array_to_string(list_transform(range(1, len(gaps) + 1),
            lambda i: gaps[i] || coalesce(list_transform(found[i:i], lambda f: {hidden})[1], '')), '') END AS {column} FROM cut""",
    }


def _text_pii() -> dict[str, str]:
    documents, pages = _in_text("documents", "doc_id", "text"), _in_text("pages", "page_id", "html")
    return {
        "text_pii_spans": documents["spans"],
        "text_pii_exposure": documents["exposure"],
        "text_masked": documents["masked"],
        "page_pii_spans": pages["spans"],
        "page_masked": pages["masked"],
    }


def all_oracles() -> dict[str, str]:
    source = f"WITH {MESSY_CUSTOMERS}"
    seen = ", ".join(
        f"CASE WHEN {c} NOT IN ({NA}) THEN {c} END AS {c}" for c in COLUMNS
    )
    return {
        **{k: f"{source}, {NORMALIZED}, {CLEANED} {q}" if not q.startswith("WITH") else
           f"{source}, {NORMALIZED}, {CLEANED}, {q.removeprefix('WITH')}" for k, q in _customers().items()},
        **{k: f"{source}, seen AS (SELECT row_id, {seen} FROM customers_raw) {q}" for k, q in _profile().items()},
        **_supplied_tables(),
        **_text_pii(),
    }
