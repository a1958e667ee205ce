"""Exact medians of several columns and groups from one scan.

The scan is a narrow copy of the wanted columns. One aggregate over it makes a
mergeable quantile sketch per column and group; the sketches of a column's
groups merge into that of the whole column. Each sketch brackets its median.
Then only values inside their bracket keep their identity, all others are
counted below or above it, so that next to nothing is shuffled or sorted. A
median that does not lie in its bracket is taken from all values of its group
instead, so the result is exact whatever the sketches say.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.functions.numbers import numeric
from dqspark.operators.ranks import quantile_ends, slices
from dqspark.operators.skew import spread_join
from dqspark.session import stage

#: Ranks, as a share of a group, between which the sketch should find the median.
BRACKET = (0.46, 0.54)
KEYS = ["column", "whole", "group"]


def _scopes(columns: Sequence[str], grouped: Sequence[str]) -> Column:
    """Where a row's values count: in the whole column, and for some in the row's group."""
    cells = [(c, True, F.lit("")) for c in columns] + [(c, False, F.col("group")) for c in grouped]
    return F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(whole).alias("whole"), g.alias("group"), F.col(f"`{c}`").alias("value"))
            for c, whole, g in cells
        ]
    )


def _sketches(cells: DataFrame, columns: Sequence[str], grouped: Sequence[str]) -> DataFrame:
    """``(column, whole, group, n, low, high)``; a group's rows meet as sketches."""
    once = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in columns])
    by_group = F.when(F.col("column").isin(list(grouped)), F.col("group"))
    parts = (
        cells.select("group", F.inline(once))
        .where(F.col("value").isNotNull())
        .groupBy("column", by_group.alias("group"))
        .agg(F.count("*").alias("n"), F.kll_sketch_agg_double("value").alias("sketch"))
    )
    of_group = F.struct(F.lit(False).alias("whole"), F.col("group").alias("group"))
    of_column = F.struct(F.lit(True).alias("whole"), F.lit("").alias("group"))
    both = F.when(F.col("group").isNull(), F.array(of_column)).otherwise(F.array(of_column, of_group))
    merged = (
        parts.withColumnRenamed("group", "_group")
        .withColumn("group", F.col("_group"))
        .select("column", "n", "sketch", F.inline(both))
        .groupBy(*KEYS)
        .agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    )
    ends = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p) for p in BRACKET]))
    return merged.select(*KEYS, "n", ends[0].alias("low"), ends[1].alias("high"))


def _counts(values: DataFrame) -> DataFrame:
    return values.groupBy(*KEYS, "value").agg(F.count("*").alias("n"))


def exact_medians(df: DataFrame, columns: Sequence[str], group: str | None = None, grouped: Sequence[str] = ()) -> DataFrame:
    """``(column, whole, group, total, median)`` of the non-missing values.

    One row per column with ``whole`` (group is empty), and one per group (as
    text) of the columns in ``grouped``; rows without a group count in the whole only. A
    column or group without values has no row. ``df`` is scanned once, when
    this is called.
    """
    by = F.col(f"`{group}`").cast("string") if group is not None else F.lit(None).cast("string")
    cells = stage(df.select(by.alias("group"), *[numeric(df, c).alias(c) for c in columns]))
    brackets = stage(_sketches(cells, columns, grouped))
    values = cells.select(F.inline(_scopes(columns, grouped))).where(
        F.col("value").isNotNull() & (F.col("whole") | F.col("group").isNotNull())
    )
    total = brackets.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    bounds = brackets.withColumnRenamed("n", "_n")
    placed = spread_join(values, bounds, KEYS, ["low", "high"], F.col("_n"), total)
    # One value stands for all below the bracket, one for all above it.
    coarse = (
        F.when(F.col("value") < F.col("low"), F.lit(float("-inf")))
        .when(F.col("value") > F.col("high"), F.lit(float("inf")))
        .otherwise(F.col("value"))
    )
    found = stage(_medians(_counts(placed.select(*KEYS, coarse.alias("value")))))
    missed = found.where(~F.col("inside"))
    if missed.count():
        again = _medians(_counts(values.join(missed.select(*KEYS), KEYS, "left_semi")))
        found = found.where("inside").unionByName(again)
    return found.drop("inside")


def _medians(counts: DataFrame) -> DataFrame:
    ends = quantile_ends(*slices(counts, KEYS), KEYS, [0.5])
    low, high = F.col("_low0"), F.col("_high0")
    infinite = [x.isin(float("-inf"), float("inf")) for x in (low, high)]
    median = F.when(low == high, low).otherwise(0.5 * low + 0.5 * high)
    return ends.select(*KEYS, "total", median.alias("median"), (~infinite[0] & ~infinite[1]).alias("inside"))
