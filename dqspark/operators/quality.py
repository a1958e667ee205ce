"""Data quality checks, the combined report and its score.

Every check contributes aggregates and report rows; a report runs all of its
aggregates in one pass over the table and unfolds the single result row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark import fixed
from dqspark.functions import numbers

REPORT_SCHEMA = "metric string, value double, status string, description string"


@dataclass
class Check:
    """Aggregates over the table and report rows built from their results."""

    aggregates: dict[str, Column] = field(default_factory=dict)
    rows: list[Column] = field(default_factory=list)

    def add(self, metric: str, value: Column, worse: Column, ok: float, warn: float, text: Column) -> None:
        self.rows.append(_row(metric, value, numbers.status(worse, ok, warn), text))


def _row(metric: str, value: Column, status: Column, text: Column) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        status.alias("status"),
        text.alias("description"),
    )


def _filled(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return numbers.numeric(df, column)
    return F.col(f"`{column}`")


def _completeness(df: DataFrame) -> Check:
    check = Check()
    for i, c in enumerate(df.columns):
        check.aggregates[f"filled_{i}"] = F.count(_filled(df, c))
        value = numbers.share(F.col(f"filled_{i}"), F.col("total"))
        text = F.lit(fixed.QUALITY_TEXTS["completeness"].format(column=c))
        check.add(f"completeness_{c}", value, 100 - value, 2, 10, text)
    return check


def _uniqueness(df: DataFrame, key: str) -> Check:
    """Distinct keys come from a scan of their own: mixed into the wide aggregate,
    every partial result would be shuffled once per key."""
    check = Check()
    keys = df.agg(F.count_distinct(F.col(key))).scalar()
    check.aggregates["unique_keys"] = F.coalesce(F.max(keys), F.lit(0))
    unique, total = F.col("unique_keys"), F.col("total")
    value = numbers.share(unique, total)
    text = F.format_string(fixed.QUALITY_TEXTS["uniqueness"], F.lit(key), unique, total, total - unique)
    check.add(f"uniqueness_{key}", value, 100 - value, 0, 1, text)
    return check


def _valid(check: Check, metric: str, condition: Column) -> None:
    check.aggregates[metric] = F.count_if(condition)
    value = numbers.share(F.col(metric), F.col("total"))
    check.add(metric, value, 100 - value, 1, 5, F.lit(fixed.QUALITY_TEXTS[metric]))


def _validity(df: DataFrame) -> Check:
    check = Check()
    if "age" in df.columns:
        _valid(check, "validity_age", numbers.numeric(df, "age").between(*fixed.AGE_RANGE))
    if "email_valido" in df.columns:
        # A plain mean: missing, not 0.0, for an empty table.
        check.aggregates["validity_email"] = F.avg(F.col("email_valido").cast("int"))
        value = F.round(F.col("validity_email") * 100, 2)
        check.add("validity_email", value, 100 - value, 1, 5, F.lit(fixed.QUALITY_TEXTS["validity_email"]))
    if "satisfaction_score" in df.columns:
        inside = numbers.numeric(df, "satisfaction_score").between(*fixed.SATISFACTION_RANGE)
        _valid(check, "validity_satisfaction_score", inside)
    if "income" in df.columns:
        _valid(check, "validity_income_positive", numbers.numeric(df, "income") > 0)
    return check


def _consistency(df: DataFrame, states: Sequence[str] | None = None) -> Check:
    check = Check()

    def in_form(metric: str, condition: Column) -> None:
        check.aggregates[metric] = F.count_if(condition)
        value = numbers.share(F.col(metric), F.col("total"))
        check.add(metric, value, 100 - value, 0, 2, F.lit(fixed.QUALITY_TEXTS[metric]))

    if "gender" in df.columns:
        categories = sorted(set(fixed.GENDER_CATEGORIES.values()))
        in_form("consistency_gender_categories", F.col("gender").isin(categories))
    if "state" in df.columns:
        allowed = F.col("state").isin(list(states)) if states else F.length("state") == fixed.STATE_CODE_LENGTH
        in_form("consistency_state_format", allowed)
    if {"purchase_count", "total_spent"} <= set(df.columns):
        metric = "consistency_purchase_vs_spent"
        spent_without_purchase = (numbers.numeric(df, "purchase_count") == 0) & (numbers.numeric(df, "total_spent") > 0)
        check.aggregates[metric] = F.count_if(spent_without_purchase)
        worse = numbers.share(F.col(metric), F.col("total"))
        check.add(metric, F.round(100 - worse, 2), worse, 0.5, 2, F.lit(fixed.QUALITY_TEXTS[metric]))
    return check


def _accuracy() -> Check:
    note = _row(
        "accuracy_note", F.lit(None), F.lit(fixed.STATUS_NA), F.lit(fixed.QUALITY_TEXTS["accuracy_note"])
    )
    return Check(rows=[note])


def _report(df: DataFrame, *checks: Check) -> DataFrame:
    rows = [row for check in checks for row in check.rows]
    if not rows:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    aggregates = {name: a for check in checks for name, a in check.aggregates.items()}
    counts = df.agg(F.count("*").alias("total"), *[a.alias(name) for name, a in aggregates.items()])
    return counts.select(F.inline(F.array(*rows)))


def check_completeness(df: DataFrame) -> DataFrame:
    """Share of filled values per column."""
    return _report(df, _completeness(df))


def check_uniqueness(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Distinct keys as a share of all rows; a missing key counts as a duplicate."""
    return _report(df, _uniqueness(df, key))


def check_validity(df: DataFrame) -> DataFrame:
    """Shares of values inside the business rules; missing counts as invalid."""
    return _report(df, _validity(df))


def check_consistency(df: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """Shares of standard categories and of rows without contradictions.

    State codes are checked by length only, unless ``states`` lists them.
    """
    return _report(df, _consistency(df, states))


def dq_report(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """All checks and the accuracy note in one table."""
    return _report(df, _completeness(df), _uniqueness(df, key), _validity(df), _consistency(df), _accuracy())


def dq_score(report: DataFrame) -> DataFrame:
    """Mean of the measured metrics, 0-100; 0.0 when nothing was measured."""
    return report.agg(F.round(F.coalesce(F.avg("value"), F.lit(0.0)), 2).alias("score"))


def dq_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two reports side by side, with the change of each metric."""
    left = before.select("metric", F.col("value").alias("before"), F.col("status").alias("status_before"))
    right = after.select("metric", F.col("value").alias("after"), F.col("status").alias("status_after"))
    return (
        left.join(right, "metric", "full")
        .withColumn("delta", F.round(F.col("after") - F.col("before"), 2))
        .select("metric", "before", "after", "delta", "status_before", "status_after")
    )


def worst_metrics(report: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` lowest metrics, lowest first, unmeasured ones last."""
    return report.orderBy(F.col("value").asc_nulls_last(), "metric").limit(n)
