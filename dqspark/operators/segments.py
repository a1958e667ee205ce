"""Quantile-based segments and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark import fixed
from dqspark.functions import numbers
from dqspark.operators.ranks import long_numbers, quantile_table, quantiles, scalar_struct, value_counts

_TERCILES = (1 / 3, 2 / 3)


def customer_segments(
    df: DataFrame, column: str = "total_spent", new_column: str = "customer_segment"
) -> DataFrame:
    """Low, Medium or High by the terciles of ``column``; equal values stay together."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r} to segment by")
    cuts = scalar_struct(
        quantiles(df, [column], _TERCILES), [column], {"low": F.col("q")[0], "high": F.col("q")[1]}
    )
    value = numbers.numeric(df, column)
    low, medium, high = fixed.SEGMENTS
    label = (
        F.when(value <= F.col("_cuts")[column]["low"], low)
        .when(value <= F.col("_cuts")[column]["high"], medium)
        .when(value.isNotNull(), high)
    )
    return df.withColumn("_cuts", cuts).withColumn(new_column, label).drop("_cuts")


def segment_summary(
    df: DataFrame,
    segment_column: str = "customer_segment",
    metrics: Sequence[str] | None = None,
    order: Sequence[str] = fixed.SEGMENTS,
) -> DataFrame:
    """Mean, median and count of each metric per segment, in the given order.

    Labels outside ``order`` are left out.
    """
    cols = [c for c in (metrics or fixed.SEGMENT_METRICS) if c in df.columns]
    kept = df.where(F.col(segment_column).isin(list(order)))
    values = long_numbers(kept, cols, [segment_column])
    keys = [segment_column, "column"]
    medians = quantile_table(value_counts(values, keys), keys, [0.5])
    # A few rows each: one per segment and metric.
    wide_medians = medians.groupBy(segment_column).agg(
        *[F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(f"{c}_median") for c in cols]
    )
    data = kept.select(segment_column, *[numbers.numeric(df, c).alias(c) for c in cols])
    means = data.groupBy(segment_column).agg(
        *[a for c in cols for a in (F.avg(c).alias(f"{c}_mean"), F.count(c).alias(f"{c}_count"))]
    )
    rank = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(segment_column))
    fields = [
        f
        for c in cols
        for f in (
            F.round(f"{c}_mean", 2).alias(f"{c}_mean"),
            F.round(f"{c}_median", 2).alias(f"{c}_median"),
            F.col(f"{c}_count"),
        )
    ]
    return means.join(wide_medians, segment_column, "left").orderBy(rank).select(segment_column, *fields)


def median_split_groups(
    df: DataFrame,
    column: str = "satisfaction_score",
    new_column: str = "grupo",
    labels: Sequence[str] = fixed.MEDIAN_SPLIT_LABELS,
) -> DataFrame:
    """Tag rows at or above the median and below it; rows without a value go."""
    middle = scalar_struct(quantiles(df, [column], [0.5]), [column], {"median": F.col("q")[0]})
    value = numbers.numeric(df, column)
    at_or_above = value >= F.col("_m")[column]["median"]
    return (
        df.where(value.isNotNull())
        .withColumn("_m", middle)
        .withColumn(new_column, F.when(at_or_above, labels[0]).otherwise(labels[1]))
        .drop("_m")
    )


def segment_axis_cap(
    df: DataFrame, segment_column: str = "customer_segment", value_column: str = "total_spent"
) -> DataFrame:
    """Highest upper whisker over the segments, with 15 % headroom (one row)."""
    values = long_numbers(df.where(F.col(segment_column).isNotNull()), [value_column], [segment_column])
    quartiles = quantile_table(value_counts(values, [segment_column]), [segment_column], [0.25, 0.75])
    whisker = F.col("q")[1] + F.lit(1.5) * (F.col("q")[1] - F.col("q")[0])
    return quartiles.agg(F.max(whisker).alias("upper_whisker")).withColumn(
        "axis_cap", F.col("upper_whisker") * 1.15
    )
