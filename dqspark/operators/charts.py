"""The numbers behind charts, small whatever the size of the table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.functions.dates import month_start
from dqspark.functions.numbers import numeric
from dqspark.operators.profile import top_values
from dqspark.operators.ranks import long_numbers, quantile_table, quantiles, value_counts
from dqspark.operators.skew import spread_join

#: exp() of anything below this is 0.0 in double precision.
EXP_UNDERFLOW = -745.2
#: Width of a density cell in bandwidths, and terms of its series.
CELL, TERMS = 0.0625, 12


def _numbers(df: DataFrame, column: str) -> DataFrame:
    return df.select(numeric(df, column).alias("value")).where(F.col("value").isNotNull())


def _extent(values: DataFrame) -> Column:
    """Scalar struct with ``low``, ``high``, ``n``, ``mean`` and ``std`` of ``value``."""
    return values.agg(
        F.struct(
            F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"),
            F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        )
    ).scalar()


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the last bin includes its right edge."""
    width = (high - low) / bins
    place = F.coalesce(F.floor(F.try_divide(value - low, width)), F.lit(0).cast("long"))
    return F.least(place, F.lit(bins - 1).cast("long"))


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max] with counts, and the mean and median."""
    values = _numbers(df, column)
    counted = (
        values.withColumn("_e", _extent(values))
        .groupBy(_bin(F.col("value"), F.col("_e.low"), F.col("_e.high"), bins).alias("bin"))
        .agg(F.count("*").alias("row_count"))
    )
    median = quantiles(df, [column], [0.5]).agg(F.max(F.col("q")[0])).scalar()
    spine = df.sparkSession.range(bins).withColumnRenamed("id", "bin").withColumn("_e", _extent(values))
    width = (F.col("_e.high") - F.col("_e.low")) / bins
    return (
        spine.join(counted, "bin", "left")
        .where(F.col("_e.n") > 0)
        .select(
            "bin",
            (F.col("_e.low") + F.col("bin") * width).alias("bin_start"),
            (F.col("_e.low") + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"),
            F.col("_e.mean").alias("mean"),
            median.alias("median"),
        )
        .orderBy("bin")
    )


def kde_grid(df: DataFrame, column: str, points: int = 200, bins: int = 40) -> DataFrame:
    """Gaussian density on a grid over [min, max], Scott's bandwidth.

    ``density`` integrates to one over the whole line; ``scaled`` is its height
    on a histogram of counts with ``bins`` bins.

    Values meet the grid by cells of CELL bandwidths: with t the distance of a
    value from its cell's middle and y that of a grid point, in bandwidths, the
    kernel is ``exp(-y^2/2) * exp(-t^2/2) * exp(y t)``, and the last factor is a
    power series in y whose coefficients are sums over the cell. TERMS of them
    leave a relative error below 1e-9 up to 29 bandwidths away, where the kernel is
    below 1e-180. So a cell, however many values it has, is one row.
    """
    values = _numbers(df, column)
    extent = _extent(values)
    low, high, n = F.col("_e.low"), F.col("_e.high"), F.col("_e.n")
    step = (high - low) / (points - 1)
    bandwidth = F.col("_e.std") * F.pow(n.cast("double"), F.lit(-0.2))
    reach = F.sqrt(F.lit(-2.0 * EXP_UNDERFLOW)) * bandwidth
    width = bandwidth * CELL
    placed = values.withColumn("_e", extent).where(F.col("_e.std") > 0)
    placed = placed.withColumn("cell", F.floor((F.col("value") - low) / width))
    middle = low + (F.col("cell") + 0.5) * width
    placed = placed.withColumn("t", (F.col("value") - middle) / bandwidth)
    term = F.exp(F.col("t") * F.col("t") / -2.0)
    coefficients = []
    for k in range(TERMS):
        coefficients.append(F.sum(term).alias(f"m{k}"))
        term = term * (F.col("t") / (k + 1))
    cells = placed.groupBy("cell").agg(*coefficients).withColumn("_e", extent)
    first = F.greatest(F.ceil((middle - reach - low) / step), F.lit(0).cast("long"))
    last = F.least(F.floor((middle + reach - low) / step), F.lit(points - 1).cast("long"))
    y = F.col("y")
    series = reduce(lambda total, k: total * y + F.col(f"m{k}"), reversed(range(TERMS - 1)), F.col(f"m{TERMS - 1}"))
    sums = (
        cells.where(first <= last)
        .withColumn("point", F.explode(F.sequence(first, last)))
        .withColumn("y", (low + F.col("point") * step - middle) / bandwidth)
        .groupBy("point")
        .agg(F.sum(F.exp(y * y / -2.0) * series).alias("weight"))
    )
    spine = df.sparkSession.range(points).withColumnRenamed("id", "point").withColumn("_e", extent)
    density = F.coalesce("weight", F.lit(0.0)) / (n * bandwidth * math.sqrt(2 * math.pi))
    return (
        spine.join(sums, "point", "left")
        .where(F.col("_e.std") > 0)
        .select(
            "point",
            (low + F.col("point") * step).alias("x"),
            density.alias("density"),
            (density * n * (high - low) / bins).alias("scaled"),
        )
        .orderBy("point")
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str], by: str | None = None, k: float = 1.5) -> DataFrame:
    """Box, whiskers and flier counts per column (and group).

    A whisker ends at the most extreme value within ``k`` interquartile ranges.
    """
    keys = [by, "column"] if by else ["column"]
    values = long_numbers(df, columns, [by] if by else [])
    probs = [0.25, 0.5, 0.75]
    if by:
        values = values.where(F.col(by).isNotNull())
        table = quantile_table(value_counts(values, keys), keys, probs)
    else:
        table = quantiles(df, columns, probs)
    q1, median, q3 = (F.col("q")[i] for i in range(3))
    boxes = table.select(
        *keys,
        F.col("total").alias("n"),
        q1.alias("q1"),
        median.alias("median"),
        q3.alias("q3"),
        (q1 - F.lit(k) * (q3 - q1)).alias("low"),
        (q3 + F.lit(k) * (q3 - q1)).alias("high"),
    )
    fields = ["n", "q1", "median", "q3", "low", "high"]
    rows = boxes.agg(F.sum("n")).scalar()
    inside = F.col("value").between(F.col("low"), F.col("high"))
    return (
        spread_join(values, boxes, keys, fields, F.col("n"), rows)
        .groupBy(*keys, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("flier_count"),
        )
    )


def counts_per_month(df: DataFrame, date_column: str = "signup_date") -> DataFrame:
    """Rows per month in order; months without rows are absent."""
    return (
        df.where(F.col(date_column).isNotNull())
        .groupBy(month_start(F.col(date_column)).alias("month"))
        .agg(F.count("*").alias("row_count"))
        .orderBy("month")
    )


def counts_per_state(df: DataFrame, column: str = "state", top_n: int = 15) -> DataFrame:
    """The ``top_n`` most frequent values of ``column``."""
    return top_values(df, column, top_n)


def _symlog(value: Column, threshold: Column) -> Column:
    """Linear up to the threshold, logarithmic (base 10) beyond it."""
    linear_part = 1 / (1 - 0.1)
    log_part = threshold * (F.lit(linear_part) + F.log10(F.greatest(F.abs(value) / threshold, F.lit(1.0))))
    return F.when(F.abs(value) <= threshold, value * linear_part).otherwise(F.signum(value) * log_part)


def scatter_bins(
    df: DataFrame,
    x: str,
    y: str,
    hue: str | None = None,
    bins: int = 50,
    log_x: bool = False,
    log_y: bool = False,
) -> DataFrame:
    """Counts on a ``bins`` x ``bins`` grid per hue: a scatter plot of any size.

    A logarithmic axis turns linear below ``max(median, 1)``.
    """
    data = df.select(
        numeric(df, x).alias("x"), numeric(df, y).alias("y"),
        *([F.col(hue).cast("string").alias("hue")] if hue else []),
    ).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    axes = [("x", x, log_x), ("y", y, log_y)]
    for name, column, logarithmic in axes:
        if logarithmic:
            median = quantiles(df, [column], [0.5]).agg(F.max(F.col("q")[0])).scalar()
            data = data.withColumn(f"_{name}", _symlog(F.col(name), F.greatest(median, F.lit(1.0))))
        else:
            data = data.withColumn(f"_{name}", F.col(name))
    extent = data.agg(
        F.struct(
            *[f(f"_{name}").alias(f"{name}_{end}") for name, _, _ in axes for end, f in (("low", F.min), ("high", F.max))]
        )
    ).scalar()
    cells = data.withColumn("_e", extent)
    keys = [
        _bin(F.col(f"_{name}"), F.col(f"_e.{name}_low"), F.col(f"_e.{name}_high"), bins).alias(f"{name}_bin")
        for name, _, _ in axes
    ]
    return cells.groupBy(*keys, *(["hue"] if hue else [])).agg(F.count("*").alias("row_count"))
