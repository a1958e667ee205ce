"""The customer job step by step: clean, deduplicate, impute, segment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dqspark import fixed
from dqspark.operators import clean, dedup, impute, segments


def type_customers(raw: DataFrame) -> DataFrame:
    """Standard column names and numeric types; texts stay as delivered.

    The state in which the raw table is judged before cleaning.
    """
    return clean.convert_numeric(clean.standardize_column_names(raw))


def clean_customers(raw: DataFrame, check_age: bool = True) -> DataFrame:
    """All cleaning steps in one narrow stage.

    ``check_age=False`` leaves ages outside the valid range in place, for the
    report about them.
    """
    cleaned = (
        clean.standardize_column_names(raw)
        .transform(clean.clean_text, fixed.TEXT_COLUMNS)
        .transform(clean.title_case_names)
        .transform(clean.standardize_gender)
        .transform(clean.standardize_state)
        .transform(clean.clean_email)
        .transform(clean.convert_numeric)
        .transform(clean.convert_dates)
    )
    return clean.validate_range(cleaned) if check_age else cleaned


def deduplicate_customers(cleaned: DataFrame) -> DataFrame:
    """No full copies, and the latest row per customer."""
    return cleaned.transform(dedup.drop_full_duplicates).transform(dedup.dedup_by_key)


def finish_customers(unique: DataFrame) -> DataFrame:
    """Missing values filled, then customers segmented by what they spent."""
    return unique.transform(impute.handle_missing).transform(segments.customer_segments)
