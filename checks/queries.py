"""Registered queries: every operator on whole tables of the driver."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import dirty_customers, messy_numbers, table
from dqspark import fixed
from dqspark.functions import dates, numbers, text
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
    ranks,
    segments,
    similarity,
)
from dqspark.plans import batch
from dqspark.plans.customers import (
    clean_customers,
    deduplicate_customers,
    finish_customers,
    type_customers,
)
from dqspark.session import scratch_dir, stage
from dqspark.sources import csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RAW_HEADERS = (
    "Customer ID", " Customer Name", "Email ", "Age", "Gender", "City", "State",
    "Signup-Date", "Income (R$)", "Purchase  Count", "Tótal Spent", "Satisfaction_Score_",
)
#: Written reports that are compared, with their columns; the first one names the row.
REPORTS = {
    "deduplication_summary": ("etapa", "quantidade"),
    "age_validation_report": ("coluna", "regra", "quantidade_invalida", "percentual_invalido", "estrategia"),
    "missing_values_strategy": ("coluna", "missing_percent", "estrategia"),
    "data_quality_report_raw": ("metric", "value", "status", "description"),
    "data_quality_report": ("metric", "value", "status", "description"),
}
#: Value columns of lineitem, and the decimals their statistics are compared with.
LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Doubles rounded for comparison, whole numbers as bigint."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind in ("double", "float"):
            c = F.round(c, special.get(f.name, digits))
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return clean_customers(dirty_customers(spark, d))


def unique(spark: SparkSession, d: str) -> DataFrame:
    """Staged: medians, joins and reports read it several times."""
    return stage(deduplicate_customers(cleaned(spark, d)))


def finished(spark: SparkSession, d: str) -> DataFrame:
    return stage(finish_customers(unique(spark, d)))


def spending(spark: SparkSession, d: str) -> DataFrame:
    """Orders summed per customer, with the customer's attributes; customers without orders have spent 0."""
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.sum(F.floor("o_totalprice").cast("bigint")).cast("double").alias("total_spent"),
        F.count("*").alias("purchase_count"),
    )
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("income"), "c_mktsegment"
    )
    return customers.join(orders, "customer_id", "left").fillna({"total_spent": 0.0, "purchase_count": 0})


# --- scan, names, text -----------------------------------------------------------


@query
def scan_csv(spark, d):
    """Names with quotes, commas and line breaks, written as CSV and scanned."""
    key = F.col("p_partkey")
    name = (
        F.when(key % 4 == 0, F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('", x')))
        .when(key % 4 == 1, F.concat(F.lit(" "), "p_name", F.lit(", ")))
        .when(key % 4 == 2, F.lit("N/A"))
        .otherwise(F.col("p_name"))
    )
    path = f"{scratch_dir(spark)}/scan-{uuid.uuid4().hex}"
    csv.save_frame(table(spark, d, "part").select(key.cast("string").alias("key"), name.alias("name")), path)
    return csv.load_raw(spark, path)


@query
def scan_processed(spark, d):
    """Processed customers some of whose cells are no values of their type."""
    key = F.col("c_custkey")
    cells = {
        "customer_id": key.cast("string"),
        "customer_name": F.col("c_name"),
        "age": F.when(key % 5 == 0, F.lit("abc")).when(key % 5 == 1, F.lit("NA")).otherwise((key % 60 + 18).cast("string")),
        "signup_date": F.when(key % 4 == 0, F.lit("2024/01/10")).otherwise(F.lit("2024-01-10")),
        "income": F.when(key % 7 == 0, F.lit("1.5.2")).otherwise(F.lit("2500.5")),
        "purchase_count": F.when(key % 6 == 0, F.lit("many")).otherwise(F.lit("12")),
    }
    names = [f.split()[0] for f in csv.PROCESSED_SCHEMA.split(", ")]
    path = f"{scratch_dir(spark)}/processed-{uuid.uuid4().hex}"
    empty = F.lit(None).cast("string")
    csv.save_frame(table(spark, d, "customer").select(*[cells.get(c, empty).alias(c) for c in names]), path)
    bad = [F.col("bad")[c].alias(f"bad_{c}") for c in ("age", "signup_date", "income", "purchase_count")]
    found = csv.load_processed(spark, path, rescued="bad")
    return found.select("customer_id", "customer_name", "age", "signup_date", "income", "purchase_count", *bad)


@query
def batch_reports(spark, d):
    """The batch job on a dirty CSV: cells of its written reports, one row each."""
    folder = f"{scratch_dir(spark)}/batch-{uuid.uuid4().hex}"
    csv.save_frame(dirty_customers(spark, d), f"{folder}/raw")
    written = batch.run(spark, f"{folder}/raw", f"{folder}/out", with_charts=False)
    parts = []
    for name, columns in REPORTS.items():
        report = spark.read.option("header", True).option("escape", '"').csv(written[name])
        cells = [
            F.struct(F.lit(name).alias("report"), F.col(columns[0]).alias("row"), F.lit(c).alias("field"), F.col(c).alias("value"))
            for c in columns[1:]
        ]
        parts.append(report.select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


@query
def scan_na_tokens(spark, d):
    token = F.expr(
        "CASE o_orderkey % 7 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN 'NaN' "
        "WHEN 4 THEN 'None ' ELSE o_orderpriority END"
    )
    return csv.null_tokens(table(spark, d, "orders").select("o_orderkey", token.alias("priority"), "o_orderstatus"))


@query
def std_column_names(spark, d):
    return clean.standardize_column_names(dirty_customers(spark, d).toDF(*RAW_HEADERS))


@query
def clean_text(spark, d):
    return clean.clean_text(table(spark, d, "documents").select("doc_id", "text"), ["text"])


@query
def title_case_name(spark, d):
    rows = dirty_customers(spark, d).select("customer_id", "customer_name", "city")
    return rows.transform(clean.clean_text, ["customer_name"]).transform(clean.title_case_names)


@query
def strip_accents(spark, d):
    return table(spark, d, "documents").select("doc_id", text.strip_accents(F.col("text")).alias("text"))


@query
def norm_key(spark, d):
    rows = dirty_customers(spark, d)
    return rows.select("customer_id", *[text.norm_key(F.col(c)).alias(f"{c}_key") for c in ("customer_name", "state", "gender")])


@query
def clean_email(spark, d):
    return clean.clean_email(dirty_customers(spark, d).select("customer_id", "email"))


@query
def std_gender(spark, d):
    return clean.standardize_gender(dirty_customers(spark, d).select("customer_id", "gender"))


@query
def std_state(spark, d):
    return clean.standardize_state(dirty_customers(spark, d).select("customer_id", "state"))


@query
def unmapped_categories(spark, d):
    rows = dirty_customers(spark, d)
    gender = clean.unmapped_categories(rows, "gender", fixed.GENDER_CATEGORIES).withColumn("column", F.lit("gender"))
    state = clean.unmapped_categories(rows, "state", clean.state_variants()).withColumn("column", F.lit("state"))
    return gender.unionByName(state)


# --- numbers and dates -------------------------------------------------------------


@query
def parse_money(spark, d):
    rows = messy_numbers(spark, d)
    return rows.select("l_orderkey", "l_linenumber", "amount", numbers.parse_money(F.col("amount")).alias("value"))


@query
def to_numeric(spark, d):
    rows = messy_numbers(spark, d)
    return rows.select("l_orderkey", "l_linenumber", "amount", numbers.to_numeric(F.col("amount")).alias("value"))


@query
def convert_numeric(spark, d):
    rows = dirty_customers(spark, d)
    return clean.convert_numeric(rows).select("customer_id", *fixed.NUMERIC_COLUMNS)


@query
def parse_dates(spark, d):
    rows = dirty_customers(spark, d)
    return rows.select("customer_id", "signup_date", dates.parse_date(F.col("signup_date")).alias("parsed"))


@query
def parse_timestamps(spark, d):
    """Order dates in ISO, textual and time-of-day layouts."""
    day = F.col("o_orderdate").cast("date")
    shown = (
        F.when(F.col("o_orderkey") % 6 == 0, F.date_format(day, "yyyyMMdd"))
        .when(F.col("o_orderkey") % 6 == 1, F.date_format(day, "MMMM d, yyyy"))
        .when(F.col("o_orderkey") % 6 == 2, F.date_format(day, "d MMM yyyy"))
        .when(F.col("o_orderkey") % 6 == 3, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 08:30:05")))
        .when(F.col("o_orderkey") % 6 == 4, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T23:59")))
        .otherwise(F.concat(F.lit("on "), F.date_format(day, "yyyy-MM-dd")))
    )
    rows = table(spark, d, "orders").select("o_orderkey", shown.alias("shown"))
    return rows.select(
        "o_orderkey", dates.parse_timestamp(F.col("shown")).alias("at"), dates.parse_date(F.col("shown")).alias("day")
    )


@query
def date_parts(spark, d):
    rows = dirty_customers(spark, d).select("customer_id", "signup_date")
    return rounded(clean.convert_dates(rows))


@query
def validate_range(spark, d):
    typed = clean.convert_numeric(dirty_customers(spark, d).select("customer_id", "age"))
    return clean.validate_range(typed)


@query
def range_report(spark, d):
    return clean.range_report(clean.convert_numeric(dirty_customers(spark, d)))


@query
def invalid_range_values(spark, d):
    return profile.invalid_range_values(dirty_customers(spark, d))


# --- imputation ------------------------------------------------------------------


@query
def impute_global_median(spark, d):
    rows = impute.impute_global_median(unique(spark, d), ["age", "satisfaction_score"])
    return rows.select("customer_id", "age", "satisfaction_score")


@query
def impute_income_by_group(spark, d):
    return impute.impute_group_median(unique(spark, d)).select("customer_id", "state", "income")


@query
def impute_without_group(spark, d):
    return impute.impute_group_median(unique(spark, d).drop("state")).select("customer_id", "income")


@query
def impute_constant(spark, d):
    return impute.impute_constant(unique(spark, d)).select("customer_id", "city")


@query
def handle_missing(spark, d):
    return impute.handle_missing(unique(spark, d)).select("customer_id", "age", "income", "satisfaction_score", "city")


@query
def missing_strategy(spark, d):
    return impute.missing_strategy(unique(spark, d))


# --- quality ---------------------------------------------------------------------


@query
def completeness(spark, d):
    return quality.check_completeness(cleaned(spark, d))


@query
def uniqueness(spark, d):
    return quality.check_uniqueness(cleaned(spark, d))


@query
def validity_checks(spark, d):
    return quality.check_validity(cleaned(spark, d))


@query
def consistency_checks(spark, d):
    return quality.check_consistency(cleaned(spark, d))


@query
def dq_report(spark, d):
    return quality.dq_report(type_customers(dirty_customers(spark, d)))


@query
def dq_score(spark, d):
    return quality.dq_score(quality.dq_report(type_customers(dirty_customers(spark, d))))


@query
def dq_before_after(spark, d):
    before = quality.dq_report(type_customers(dirty_customers(spark, d)))
    return quality.dq_before_after(before, quality.dq_report(finished(spark, d)))


@query
def worst_metrics(spark, d):
    return quality.worst_metrics(quality.dq_report(type_customers(dirty_customers(spark, d)))).select("metric", "value", "status")


# --- profiling ---------------------------------------------------------------------


@query
def table_profile(spark, d):
    return profile.table_profile(dirty_customers(spark, d))


@query
def missing_summary(spark, d):
    return profile.missing_summary(dirty_customers(spark, d))


@query
def cardinality(spark, d):
    return profile.cardinality(table(spark, d, "orders"))


@query
def value_counts(spark, d):
    return profile.value_counts(table(spark, d, "events"), "event_type")


@query
def value_share_top5(spark, d):
    return profile.value_shares(unique(spark, d), "state", top=5)


@query
def yearly_counts(spark, d):
    rows = clean.convert_dates(table(spark, d, "orders").select("o_orderdate"), "o_orderdate")
    return rounded(profile.value_counts(rows, "o_orderdate_year", order="value"))


@query
def describe_text(spark, d):
    return profile.describe_text(table(spark, d, "lineitem"), table(spark, d, "lineitem").columns)


@query
def distinct_values(spark, d):
    return profile.distinct_values(dirty_customers(spark, d), "state")


# --- duplicates --------------------------------------------------------------------


@query
def full_duplicates(spark, d):
    return dedup.full_duplicates(dirty_customers(spark, d))


@query
def drop_full_duplicates(spark, d):
    return dedup.drop_full_duplicates(dirty_customers(spark, d))


@query
def key_duplicates(spark, d):
    return dedup.key_duplicates(dedup.drop_full_duplicates(dirty_customers(spark, d)))


@query
def dedup_by_key(spark, d):
    return dedup.dedup_by_key(table(spark, d, "orders"), "o_custkey", "o_orderdate")


@query
def dedup_keep_first(spark, d):
    return dedup.dedup_by_key(table(spark, d, "events"), "user_id", "ts", keep="first")


@query
def dedup_keep_none(spark, d):
    return dedup.dedup_by_key(dirty_customers(spark, d), "customer_id", keep=False)


@query
def duplicate_counts(spark, d):
    return dedup.duplicate_counts(dirty_customers(spark, d))


@query
def dedup_summary(spark, d):
    return dedup.dedup_summary(cleaned(spark, d), fuzzy.fuzzy_duplicates(unique(spark, d)))


@query
def fuzzy_duplicates(spark, d):
    return fuzzy.fuzzy_duplicates(unique(spark, d))


@query
def fuzzy_record_pairs(spark, d):
    """Single records behind some similar names, in a table with repeated ids."""
    people = cleaned(spark, d).select("customer_id", "customer_name")
    pairs = fuzzy.fuzzy_duplicates(people).where((F.col("block") == "p") & F.col("tokens_1").startswith("1"))
    return fuzzy.expand_record_pairs(pairs, people)


@query
def fuzzy_repeated_ids(spark, d):
    return fuzzy.fuzzy_duplicates(cleaned(spark, d))


@query
def fuzzy_part_names(spark, d):
    return fuzzy.fuzzy_duplicates(table(spark, d, "part"), "p_name", threshold=70.0, id_column="p_partkey")


@query
def token_sort_similarity(spark, d):
    parts = table(spark, d, "part")
    other = F.lower(F.concat_ws(" ", "p_type", "p_name"))
    return parts.select(
        "p_partkey", F.round(similarity.token_sort_ratio(F.col("p_name"), other), 6).alias("similarity")
    )


# --- describe, outliers, segments ------------------------------------------------------


@query
def describe_numeric(spark, d):
    return rounded(describe.describe_numeric(table(spark, d, "lineitem"), LINE_COLUMNS), 4, variance=2, mean=2, std=2)


@query
def describe_customers(spark, d):
    return rounded(describe.describe_numeric(finished(spark, d)), 4, variance=0, mean=2, std=2)


@query
def describe_basic(spark, d):
    return rounded(describe.describe_basic(table(spark, d, "events"), ["value"]), 4)


@query
def distribution_shape(spark, d):
    statistics = describe.describe_numeric(table(spark, d, "events"), ["event_id", "user_id", "value"])
    return describe.distribution_shape(statistics)


@query
def quantiles(spark, d):
    return rounded(describe.quantile_rows(table(spark, d, "lineitem"), LINE_COLUMNS, [0.01, 1 / 3, 0.5, 2 / 3, 0.999]))


@query
def outliers_iqr(spark, d):
    return rounded(describe.outliers_iqr(table(spark, d, "events"), ["user_id", "value"]))


@query
def outlier_actions(spark, d):
    return describe.outlier_actions(describe.outliers_iqr(finished(spark, d)))


@query
def customer_segments(spark, d):
    return segments.customer_segments(spending(spark, d)).select("customer_id", "total_spent", "customer_segment")


@query
def segment_summary(spark, d):
    return rounded(segments.segment_summary(segments.customer_segments(spending(spark, d))))


@query
def median_split_groups(spark, d):
    return segments.median_split_groups(unique(spark, d)).select("customer_id", "satisfaction_score", "grupo")


@query
def segment_axis_cap(spark, d):
    return rounded(segments.segment_axis_cap(segments.customer_segments(spending(spark, d))), 4)


# --- ranks, correlation, tests ---------------------------------------------------------


@query
def avg_rank(spark, d):
    lines = table(spark, d, "lineitem")
    counts = ranks.value_counts(ranks.long_numbers(lines, LINE_COLUMNS), ["column"])
    return ranks.average_ranks(counts, ["column"]).select("column", "value", "n", "avg_rank")


@query
def avg_rank_rows(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ranks.with_average_rank(lines, "l_extendedprice")


@query
def corr_pearson(spark, d):
    return rounded(corr.correlation_matrix(table(spark, d, "lineitem"), LINE_COLUMNS))


@query
def corr_spearman(spark, d):
    return rounded(corr.correlation_matrix(table(spark, d, "lineitem"), LINE_COLUMNS, "spearman"))


@query
def corr_spearman_missing(spark, d):
    """Columns with gaps: every pair is ranked over its own complete rows."""
    return rounded(corr.correlation_matrix(unique(spark, d), method="spearman"))


@query
def top_corr_pairs(spark, d):
    return rounded(corr.top_correlated_pairs(table(spark, d, "lineitem"), LINE_COLUMNS, "spearman", top_n=4))


@query
def test_pearson(spark, d):
    return hypothesis.pearson_test(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")


@query
def test_spearman(spark, d):
    return hypothesis.spearman_test(table(spark, d, "lineitem"), "l_discount", "l_tax")


@query
def test_welch_t(spark, d):
    orders = table(spark, d, "orders")
    return hypothesis.welch_test(orders, "o_totalprice", "o_orderstatus", "F", "O")


@query
def test_mann_whitney_small(spark, d):
    """Three orders against all others: exact, however many those are.

    Orders whose keys differ by millions can have one value; they are ranked by their keys.
    """
    orders = table(spark, d, "orders")
    value = F.round(F.col("o_totalprice") * 100).cast("bigint") * 1_000_000 + F.col("o_orderkey")
    third = orders.agg(F.array_sort(F.slice(F.array_sort(F.collect_list(F.when(F.col("o_orderkey") % 5000 == 1, F.col("o_orderkey")))), 1, 3))).scalar()
    few = F.array_contains(third, F.col("o_orderkey"))
    rows = orders.select(value.cast("double").alias("value"), F.when(few, "few").otherwise("rest").alias("side"), "o_orderkey")
    found = hypothesis.mann_whitney_stats(rows, "value", "side", "few", "rest", "exact", apart="o_orderkey")
    return found.select("n_a", "n_b", "median_a", "median_b", "statistic", F.round("p_value", 12).alias("p_value"))


@query
def test_mann_whitney(spark, d):
    return hypothesis.mann_whitney_test(table(spark, d, "events"), "value", "event_type", "click", "error")


@query
def test_anova(spark, d):
    return hypothesis.anova_test(table(spark, d, "orders"), "o_totalprice", "o_orderpriority")


@query
def test_battery(spark, d):
    return hypothesis.standard_battery(finished(spark, d))


# --- chart data ------------------------------------------------------------------------


@query
def histogram(spark, d):
    return rounded(charts.histogram(table(spark, d, "events"), "value"))


@query
def kde_grid(spark, d):
    return rounded(charts.kde_grid(table(spark, d, "events"), "value"), 8, scaled=5)


@query
def boxplot_stats(spark, d):
    return rounded(charts.boxplot_stats(table(spark, d, "events"), ["value"], by="event_type"))


@query
def boxplot_overall(spark, d):
    return rounded(charts.boxplot_stats(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"]))


@query
def state_counts_topn(spark, d):
    return charts.counts_per_state(unique(spark, d), top_n=4)


@query
def monthly_counts(spark, d):
    return charts.counts_per_month(table(spark, d, "orders"), "o_orderdate")


@query
def scatter_bins(spark, d):
    return charts.scatter_bins(spending(spark, d), "purchase_count", "total_spent", hue="c_mktsegment", log_y=True)
