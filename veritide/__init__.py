"""Data quality, PII detection, cleaning and masking of customer tables on Spark."""
