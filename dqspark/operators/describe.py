"""Descriptive statistics and outliers of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark import fixed
from dqspark.functions import numbers
from dqspark.operators.ranks import (
    long_numbers,
    modes,
    quantiles,
    quantiles_of_slices,
    scalar_struct,
    slices,
    value_counts,
)


def present(df: DataFrame, columns: Sequence[str] | None, default=fixed.NUMERIC_COLUMNS) -> list[str]:
    return list(columns) if columns else [c for c in default if c in df.columns]


def _rows(*structs: Column) -> Column:
    return F.inline(F.array(*structs))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row of statistics per column; columns without a value are left out.

    Moments come from one aggregate over the source, order statistics and mode
    from one staged table of value counts. Skewness and excess kurtosis are population values.
    """
    cols = present(df, columns)
    probs = [p / 100 for p in fixed.PERCENTILES]
    sliced, totals = slices(value_counts(long_numbers(df, cols), ["column"]), ["column"])
    order = scalar_struct(quantiles_of_slices(sliced, totals, ["column"], probs), cols, {"q": F.col("q")})
    mode = scalar_struct(modes(sliced, ["column"]), cols, {"mode": F.col("mode")})
    numbers_only = df.select(*[numbers.numeric(df, c).alias(c) for c in cols])
    moments = numbers_only.agg(*[a.alias(f"{c}_{name}") for c in cols for name, a in _moments(c).items()])

    def row(c: str) -> Column:
        def m(name: str) -> Column:
            return F.col(f"{c}_{name}")

        q = {p: F.col("_order")[c]["q"][i] for i, p in enumerate(fixed.PERCENTILES)}
        fields = {
            "column": F.lit(c),
            "count": m("count"),
            "mean": m("mean"),
            "median": q[50],
            "mode": F.col("_mode")[c]["mode"],
            "std": m("std"),
            "variance": m("variance"),
            "min": m("min"),
            "max": m("max"),
            "range": m("max") - m("min"),
            "q1": q[25],
            "q3": q[75],
            "iqr": q[75] - q[25],
            **{f"p{p}": q[p] for p in fixed.PERCENTILES},
            "skewness": F.when(m("spread") > 0, m("skewness")),
            "kurtosis": F.when(m("spread") > 0, m("kurtosis")),
            "coefficient_of_variation": F.try_divide(m("std"), m("mean")) * 100,
        }
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    return (
        moments.withColumns({"_order": order, "_mode": mode})
        .select(_rows(*[row(c) for c in cols]))
        .where(F.col("count") > 0)
    )


def _moments(c: str) -> dict[str, Column]:
    spread = F.var_pop(c)
    return {
        "count": F.count(c),
        "mean": F.avg(c),
        # One value has no sample deviation; the aggregate itself would divide by zero.
        "std": F.when(F.count(c) > 1, F.stddev_samp(c)),
        "variance": F.when(F.count(c) > 1, F.var_samp(c)),
        "min": F.min(c),
        "max": F.max(c),
        "spread": spread,
        "skewness": F.when(spread > 0, F.skewness(c)),
        "kurtosis": F.when(spread > 0, F.kurtosis(c)),
    }


def describe_basic(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation and the five-number summary, with exact quartiles."""
    return describe_numeric(df, columns).select(
        "column", "count", "mean", "std", "min",
        F.col("q1").alias("p25"), F.col("median").alias("p50"), F.col("q3").alias("p75"), "max",
    )


def distribution_shape(statistics: DataFrame) -> DataFrame:
    """Labels of asymmetry and tail weight for a ``describe_numeric`` result."""
    return statistics.select(
        "column",
        numbers.skew_label(F.col("skewness")).alias("assimetria"),
        numbers.kurtosis_label(F.col("kurtosis")).alias("curtose"),
    )


def quantile_rows(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles in long form: ``(column, prob, value)``."""
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("q").alias("value"))
    return quantiles(df, columns, probs).select("column", F.inline(pairs).alias("prob", "value"))


def outliers_iqr(df: DataFrame, columns: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """Counts of values outside ``[q1 - k*iqr, q3 + k*iqr]``; nothing is removed."""
    cols = present(df, columns)
    quartiles = quantiles(df, cols, [0.25, 0.75])
    q1, q3 = F.col("q")[0], F.col("q")[1]
    bounds = scalar_struct(
        quartiles,
        cols,
        {
            "q1": q1,
            "q3": q3,
            "low": q1 - F.lit(k) * (q3 - q1),
            "high": q3 + F.lit(k) * (q3 - q1),
        },
    )
    data = df.select(*[numbers.numeric(df, c).alias(c) for c in cols]).withColumn("_b", bounds)
    counts = data.agg(
        *[F.count(c).alias(f"{c}_n") for c in cols],
        *[
            F.count_if((F.col(c) < F.col("_b")[c]["low"]) | (F.col(c) > F.col("_b")[c]["high"])).alias(f"{c}_out")
            for c in cols
        ],
    ).withColumn("_b", bounds)

    def row(c: str) -> Column:
        b, n, out = F.col("_b")[c], F.col(f"{c}_n"), F.col(f"{c}_out")
        return F.struct(
            F.lit(c).alias("column"),
            b["q1"].alias("q1"),
            b["q3"].alias("q3"),
            (b["q3"] - b["q1"]).alias("iqr"),
            b["low"].alias("lower_bound"),
            b["high"].alias("upper_bound"),
            n.alias("total_records"),
            out.alias("outlier_count"),
            numbers.share(out, n).alias("outlier_percentage"),
        )

    return counts.select(_rows(*[row(c) for c in cols])).where(F.col("total_records") > 0)


def outlier_actions(outliers: DataFrame) -> DataFrame:
    """Suggested treatment for each row of an ``outliers_iqr`` result."""
    return outliers.select(
        "column", "outlier_percentage", numbers.outlier_action(F.col("outlier_percentage")).alias("action")
    )
