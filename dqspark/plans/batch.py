"""The whole job: raw CSV in, processed customers and all reports out.

    spark-submit -m dqspark.plans.batch SOURCE TARGET
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from dqspark.operators import (
    charts,
    clean,
    corr,
    dedup,
    describe,
    fuzzy,
    hypothesis,
    impute,
    profile,
    quality,
    segments,
)
from dqspark.plans.customers import clean_customers, deduplicate_customers, finish_customers, type_customers
from dqspark.session import Scratch, get_spark, stage
from dqspark.sources import csv


def reports_on_processed(done: DataFrame) -> dict[str, DataFrame]:
    """Reports on the processed table, each a small lazy DataFrame."""
    return {
        "data_quality_report": quality.dq_report(done),
        "descriptive_statistics": describe.describe_numeric(done),
        "correlation_matrix": corr.correlation_matrix(done),
        "correlation_matrix_spearman": corr.correlation_matrix(done, method="spearman"),
        "top_correlated_pairs_pearson": corr.top_correlated_pairs(done),
        "top_correlated_pairs_spearman": corr.top_correlated_pairs(done, method="spearman"),
        "outliers_report": describe.outliers_iqr(done),
        "statistical_tests": hypothesis.standard_battery(done),
    }


def chart_data(done: DataFrame) -> dict[str, DataFrame]:
    """The numbers behind the charts on the processed table."""
    return {
        **{f"histogram_{c}": charts.histogram(done, c) for c in ("age", "income", "total_spent")},
        **{f"density_{c}": charts.kde_grid(done, c) for c in ("age", "income", "total_spent")},
        "boxplots": charts.boxplot_stats(done, ["income", "total_spent", "purchase_count"]),
        "segment_boxplots": charts.boxplot_stats(done, ["total_spent"], by="customer_segment"),
        "segment_axis_cap": segments.segment_axis_cap(done),
        "segment_summary": segments.segment_summary(done),
        "segment_counts": profile.value_counts(done, "customer_segment"),
        "customers_by_state": charts.counts_per_state(done),
        "customers_by_month": charts.counts_per_month(done),
        "income_vs_total_spent": charts.scatter_bins(
            done, "income", "total_spent", hue="customer_segment", log_x=True, log_y=True
        ),
        "purchase_count_vs_total_spent": charts.scatter_bins(done, "purchase_count", "total_spent", log_y=True),
        "satisfaction_vs_total_spent": charts.scatter_bins(done, "satisfaction_score", "total_spent"),
    }


def run(spark: SparkSession, source: str, target: str, with_charts: bool = True) -> dict[str, str]:
    """Run the job; returns the written datasets by name.

    The scanned source, the cleaned, the deduplicated and the processed table are staged
    once each as columnar tables, because many reports read them. Everything
    else is a single small aggregation.
    """
    with Scratch(spark):  # staged tables go even if the job fails
        return _run(spark, source, target, with_charts)


def _run(spark: SparkSession, source: str, target: str, with_charts: bool) -> dict[str, str]:
    raw = stage(csv.load_raw(spark, source))
    typed = type_customers(raw)
    cleaned = stage(clean_customers(raw, check_age=False))
    valid = clean.validate_range(cleaned)
    unique = stage(deduplicate_customers(valid))
    done = stage(finish_customers(unique))
    similar = stage(fuzzy.fuzzy_duplicates(unique))

    reports = {
        "raw_profile": profile.table_profile(clean.standardize_column_names(raw)),
        "missing_values_raw": profile.missing_summary(clean.standardize_column_names(raw)),
        "duplicates_raw": dedup.duplicate_counts(clean.standardize_column_names(raw)),
        "data_quality_report_raw": quality.dq_report(typed),
        "age_validation_report": clean.range_report(cleaned),
        "deduplication_summary": dedup.dedup_summary(valid, similar),
        "missing_values_strategy": impute.missing_strategy(unique),
        **reports_on_processed(done),
        **({f"charts/{name}": df for name, df in chart_data(done).items()} if with_charts else {}),
    }
    data = {"customers_clean": done, "fuzzy_duplicates_report": similar}
    written = {}
    for name, df in {**data, **reports}.items():
        written[name] = f"{target.rstrip('/')}/{name}"
        csv.save_frame(df, written[name], single_file=name in reports)
    return written


if __name__ == "__main__":
    run(get_spark("dqspark"), *sys.argv[1:3])
