from datetime import date

from pyspark.sql import functions as F
from tests.conftest import rows

from dqspark.operators import clean as cleaning
from dqspark.operators import dedup, fuzzy
from dqspark.plans.customers import clean_customers, deduplicate_customers


def test_full_duplicates_are_listed_and_removed(raw):
    df = cleaning.standardize_column_names(raw)
    assert dedup.full_duplicates(df).count() == 3
    assert dedup.drop_full_duplicates(df).count() == 9


def test_full_duplicates_count_nulls_as_equal_and_are_sorted(spark):
    df = spark.createDataFrame([(2, None), (1, "a"), (2, None), (3, "b"), (1, "a"), (1, "a")], "k int, v string")
    assert rows(dedup.full_duplicates(df)) == [(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None)]


def test_a_row_with_many_copies_is_listed_whole(spark, monkeypatch):
    monkeypatch.setattr(dedup, "COPIES_PER_TASK", 7)
    df = spark.range(100).select((F.col("id") * 0).alias("k")).union(spark.range(1, 3))
    assert dedup.full_duplicates(df).groupBy("k").count().collect() == [(0, 100)]


def test_key_duplicates_are_left_after_full_ones_are_gone(raw):
    df = dedup.drop_full_duplicates(cleaning.standardize_column_names(raw))
    assert [r.customer_id for r in dedup.key_duplicates(df).collect()] == ["C-15", "C-15", "C-16", "C-16"]


def test_key_duplicates_with_hot_and_missing_keys(spark):
    data = [("hot", i) for i in range(300)] + [("one", 1), (None, 1), (None, 2), ("two", 1), ("two", 2)]
    df = spark.createDataFrame(data, "customer_id string, v int")
    found = rows(dedup.key_duplicates(df))
    assert len(found) == 304 and [r[0] for r in found[-2:]] == [None, None]
    assert found[:300] == [("hot", i) for i in range(300)]


def three(spark):
    return spark.createDataFrame(
        [("A", date(2024, 1, 1), 1), ("A", date(2024, 6, 1), 5), ("B", date(2024, 2, 1), 2)],
        "customer_id string, signup_date date, purchase_count int",
    )


def test_latest_row_per_key_is_kept(spark):
    assert sorted(rows(dedup.dedup_by_key(three(spark)).drop("signup_date"))) == [("A", 5), ("B", 2)]
    assert sorted(rows(dedup.dedup_by_key(three(spark), keep="first").drop("signup_date"))) == [("A", 1), ("B", 2)]
    assert rows(dedup.dedup_by_key(three(spark), keep=False).drop("signup_date")) == [("B", 2)]


def test_missing_dates_count_as_latest_unless_told_otherwise(spark):
    df = three(spark).union(spark.createDataFrame([("A", None, 9)], three(spark).schema))
    pick = lambda **o: dict(rows(dedup.dedup_by_key(df, **o).select("customer_id", "purchase_count")))["A"]
    assert pick() == 9 and pick(missing="earliest") == 5
    assert pick(keep="first") == 1 and pick(keep="first", missing="earliest") == 9


def test_ties_are_decided_by_the_other_columns(spark):
    df = spark.createDataFrame([("A", 1, 3, "x"), ("A", 1, 3, "z"), ("A", 1, 2, "zz")], "customer_id string, signup_date int, a int, b string")
    assert rows(dedup.dedup_by_key(df)) == [("A", 1, 3, "z")]
    assert rows(dedup.dedup_by_key(df, tie_breakers=["b"])) == [("A", 1, 2, "zz")]


def test_latest_row_filter_runs_before_the_shuffle(spark):
    plan = dedup.dedup_by_key(three(spark))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_duplicate_counts(raw):
    found = dedup.duplicate_counts(cleaning.standardize_column_names(raw)).first()
    assert (found.total_rows, found.full_duplicate_rows, found.rows_in_repeated_keys) == (11, 2, 7)
    assert (found.distinct_keys, found.rows_minus_keys) == (7, 4)


def test_duplicate_counts_of_nothing(raw):
    assert dedup.duplicate_counts(cleaning.standardize_column_names(raw).limit(0)).first().total_rows == 0


def test_summary_of_the_whole_step(raw):
    cleaned = clean_customers(raw)
    similar = fuzzy.fuzzy_duplicates(deduplicate_customers(cleaned))
    summary = dedup.dedup_summary(cleaned, similar)
    assert summary.columns == ["etapa", "quantidade"]
    assert [r.quantidade for r in summary.collect()] == [11, 2, 2, 7, 1]
