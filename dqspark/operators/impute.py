"""Documented imputation: medians are taken before anything is filled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark import fixed
from dqspark.functions import numbers
from dqspark.operators.medians import exact_medians
from dqspark.operators.ranks import scalar_struct
from dqspark.operators.skew import spread_join
from dqspark.session import stage


def impute_medians(df: DataFrame, columns: Sequence[str], by_group: Sequence[str] = (), group: str = "state") -> DataFrame:
    """Fill ``columns`` with their own medians, ``by_group`` with those of the row's group.

    All medians come from one scan of ``df`` as it is given, so no fill changes
    another. Rows without a group, and groups without a value, take the overall
    median, as does every row when the group column does not exist. Absent
    columns are skipped.
    """
    cols = [c for c in dict.fromkeys([*columns, *by_group]) if c in df.columns]
    if not cols:
        return df
    grouped = [c for c in by_group if c in df.columns] if group in df.columns else []
    medians = exact_medians(df, cols, group if grouped else None, grouped)
    if grouped:
        medians = stage(medians)
    overall = scalar_struct(medians.where("whole"), cols, {"median": F.col("median")})
    filled = df
    if grouped:
        per_column = [F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"_of_{c}") for c in grouped]
        table = (
            medians.where(~F.col("whole"))
            .groupBy(F.col("group").alias("_group"))
            .agg(F.max("total").alias("_total"), *per_column)
        )
        total = medians.where("whole").agg(F.coalesce(F.max("total"), F.lit(0))).scalar()
        rows = df.withColumn("_group", F.col(f"`{group}`").cast("string"))
        filled = spread_join(rows, table, ["_group"], [f"_of_{c}" for c in grouped], F.col("_total"), total)
    filled = filled.withColumn("_all", overall)

    def value(c: str):
        own = [F.col(f"_of_{c}")] if c in grouped else []
        return F.coalesce(numbers.numeric(df, c), *own, F.col("_all")[c]["median"])

    return filled.withColumns({c: value(c) for c in cols}).select(*[F.col(f"`{c}`") for c in df.columns])


def impute_global_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill each column with its own median; absent columns are skipped."""
    return impute_medians(df, columns)


def impute_group_median(df: DataFrame, column: str = "income", group: str = "state") -> DataFrame:
    """Fill with the median of the row's group, else with the overall median."""
    return impute_medians(df, [], [column], group)


def impute_constant(df: DataFrame, column: str = "city", value: str = fixed.CITY_DEFAULT) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit(value)))


def handle_missing(df: DataFrame, group: str = "state") -> DataFrame:
    """Age and satisfaction by median, income by group median, city by a constant."""
    return impute_constant(impute_medians(df, ["age", "satisfaction_score"], ["income"], group)).select(*df.columns)


STRATEGY_SCHEMA = "coluna string, missing_percent double, estrategia string"


def missing_strategy(df: DataFrame, group: str = "state") -> DataFrame:
    """What ``handle_missing`` does to each column and how much was missing."""
    by_median = [c for c in ("age", "satisfaction_score") if c in df.columns]
    order = [c for c in ("age", "income", "satisfaction_score", "city") if c in df.columns]
    if not order:
        return df.sparkSession.createDataFrame([], STRATEGY_SCHEMA)

    def missing(c: str):
        value = F.col(c) if c == "city" else numbers.numeric(df, c)
        return F.count_if(value.isNull())

    counts = df.agg(F.count("*").alias("total"), *[missing(c).alias(c) for c in order])
    if by_median:
        medians = exact_medians(df, by_median)
        counts = counts.withColumn("_m", scalar_struct(medians, by_median, {"median": F.col("median")}))
    income_text = fixed.MISSING_TEXTS["group"].format(group=group) if group in df.columns else fixed.MISSING_TEXTS["global_only"]

    def text(c: str):
        if c in by_median:
            return F.format_string(fixed.MISSING_TEXTS["global"], F.bround(F.col("_m")[c]["median"], 1))
        return F.lit(income_text if c == "income" else fixed.MISSING_TEXTS["constant"])

    rows = [
        F.struct(
            F.lit(c).alias("coluna"),
            numbers.share(F.col(c), F.col("total")).alias("missing_percent"),
            text(c).alias("estrategia"),
        )
        for c in order
    ]
    return counts.select(F.inline(F.array(*rows)))
