"""Profiling: what is in a table before anything is changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark import fixed
from dqspark.functions import numbers


def _quoted(column: str):
    return F.col(f"`{column}`")


def _present(df: DataFrame, column: str):
    """The column with NaN, if it can hold any, as NULL."""
    if df.schema[column].dataType.typeName() in ("double", "float"):
        return F.when(~F.isnan(_quoted(column)), _quoted(column))
    return _quoted(column)


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows of the table, filled values."""
    counts = df.agg(
        F.count("*").alias("row_count"),
        *[F.count(_present(df, c)).alias(f"_f{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(i + 1).cast("long").alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("row_count"),
            F.lit(len(df.columns)).cast("long").alias("column_count"),
            F.col(f"_f{i}").alias("non_null_count"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*rows)))


def missing_summary(df: DataFrame) -> DataFrame:
    """Columns with missing values, most missing first."""
    return (
        table_profile(df)
        .withColumn("missing_count", F.col("row_count") - F.col("non_null_count"))
        .where(F.col("missing_count") > 0)
        .select("column", "missing_count", numbers.share(F.col("missing_count"), F.col("row_count")).alias("missing_percentage"))
        .orderBy(F.desc("missing_count"), "column")
    )


def _text_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` of all non-missing values as text, in one shuffle."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), _present(df, c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(cells)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    )


def _per_column(df: DataFrame, columns: Sequence[str], result: DataFrame) -> DataFrame:
    """Add the columns that have no value at all (a handful of literal rows)."""
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(result, "column", "left")


def cardinality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values per column, highest first."""
    cols = list(columns or df.columns)
    counted = _text_counts(df, cols).groupBy("column").agg(F.count("*").alias("_d"))
    return (
        _per_column(df, cols, counted)
        .select("column", F.coalesce("_d", F.lit(0).cast("long")).alias("distinct_count"))
        .orderBy(F.desc("distinct_count"), "column")
    )


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per column.

    The smallest of equally frequent values is reported.
    """
    cols = list(columns or df.columns)
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("value").alias("value")))
    summary = (
        _text_counts(df, cols)
        .groupBy("column")
        .agg(F.sum("n").alias("_count"), F.count("*").alias("_unique"), best.alias("_best"))
    )
    zero = F.lit(0).cast("long")
    return _per_column(df, cols, summary).select(
        "column",
        F.coalesce("_count", zero).alias("count"),
        F.coalesce("_unique", zero).alias("unique"),
        F.col("_best.value").alias("top"),
        (-F.col("_best.minus_n")).alias("freq"),
    )


def value_counts(df: DataFrame, column: str, order: str = "count") -> DataFrame:
    """Rows per value, missing left out; by falling count or by rising value."""
    counts = (
        df.select(_present(df, column).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count("*").alias("row_count"))
    )
    return counts.orderBy("value") if order == "value" else counts.orderBy(F.desc("row_count"), "value")


def value_shares(df: DataFrame, column: str, top: int | None = None, decimals: int = 1) -> DataFrame:
    """Percentage of each value among the non-missing ones, largest first."""
    total = df.agg(F.count(_present(df, column))).scalar()
    share = F.round(F.try_divide(F.col("row_count") * 100.0, total), decimals)
    shares = value_counts(df, column).withColumn("percentage", share)
    ordered = shares.orderBy(F.desc("row_count"), "value")
    return ordered.limit(top) if top else ordered


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values."""
    return value_counts(df, column).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(_present(df, column).alias("value")).dropna().distinct().orderBy("value")


def invalid_range_values(
    df: DataFrame, column: str = "age", low: float = fixed.AGE_RANGE[0], high: float = fixed.AGE_RANGE[1]
) -> DataFrame:
    """Values outside the closed range as written, with their counts."""
    value = numbers.numeric(df, column)
    wrong = df.where(value.isNotNull() & ~value.between(low, high))
    return value_counts(wrong, column)
