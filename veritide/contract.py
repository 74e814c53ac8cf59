"""The customer table's contract: columns, thresholds, patterns and word lists."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and the type each column should hold.
EXPECTED_TYPES = {
    "customer_id": "integer",
    "first_name": "string",
    "last_name": "string",
    "email": "string (email format)",
    "phone": "string (phone format)",
    "date_of_birth": "date (YYYY-MM-DD)",
    "address": "string",
    "income": "numeric",
    "account_status": "categorical",
    "created_date": "date (YYYY-MM-DD)",
}
COLUMNS = list(EXPECTED_TYPES)
SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in COLUMNS])
KEY = "customer_id"
ROW_ID = "row_id"

# Domains and thresholds.
STATUSES = ["active", "inactive", "suspended"]
NAME_LENGTH = (2, 50)
ADDRESS_LENGTH = (10, 200)
INCOME_RANGE = (0, 10_000_000)
AGE_RANGE = (0, 150)
DAYS_PER_YEAR = 365.25
INVALID_DATE = "invalid_date"

# Patterns.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"^\+?1?[\s.-]?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}$"
CANONICAL_PHONE_PATTERN = r"^\d{3}-\d{3}-\d{4}$"
NAME_PATTERN = r"^[A-Za-z]+(?:[ '-][A-Za-z]+)*$"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"

# What an untyped CSV reader takes for a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# PII categories, their risk and the columns of a full identity.
PII_CATEGORIES = {
    "name": ("Medium", ["first_name", "last_name"]),
    "contact_info": ("High", ["email", "phone"]),
    "sensitive_personal": ("High", ["date_of_birth", "address"]),
    "financial": ("Medium", ["income"]),
}
IDENTITY_COLUMNS = ["first_name", "last_name", "email", "phone", "date_of_birth", "address"]

# Mask texts.
MASK = "***"
MASKED_PHONE_PREFIX = "***-***-"
MASKED_ADDRESS = "[MASKED ADDRESS]"
MASKED_DATE = "****-**-**"
MASKED_MONTH_AND_DAY = "-**-**"

# What to do with a missing value, and what to fill in.
MISSING_STRATEGY = {
    "customer_id": "drop",
    "first_name": "placeholder",
    "last_name": "placeholder",
    "email": "flag",
    "phone": "flag",
    "date_of_birth": "flag",
    "address": "flag",
    "income": "flag",
    "account_status": "placeholder",
    "created_date": "flag",
}
PLACEHOLDERS = {"first_name": "Unknown", "last_name": "Unknown", "account_status": "unknown"}
