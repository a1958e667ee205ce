import random
from statistics import median

import pytest
from pyspark.sql import functions as F
from tests.conftest import by, rows

from dqspark.operators import clean as cleaning
from dqspark.operators import impute, medians, profile, quality
from dqspark.plans.customers import type_customers


def test_completeness(clean):
    gap = clean.withColumn("city", F.when(F.col("customer_id") != "D-1", F.col("city")))
    city = by(quality.check_completeness(gap), "metric")["completeness_city"]
    assert (city["value"], city["status"]) == (80.0, "CRÍTICO")


def test_nan_is_not_a_filled_value(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "age double")
    assert quality.check_completeness(df).first().value == 50.0
    assert quality.check_validity(df.replace(1.0, 40.0)).first().value == 50.0


def test_uniqueness(clean):
    assert quality.check_uniqueness(clean).first().value == 100.0
    twice = quality.check_uniqueness(clean.union(clean.limit(1))).first()
    assert twice.value == 83.33 and "(5 de 6 registros; 1 duplicados)" in twice.description


def test_uniqueness_needs_its_key(clean):
    with pytest.raises(Exception, match="nope"):
        quality.check_uniqueness(clean, key="nope")


def test_validity(clean):
    assert {r.value for r in quality.check_validity(clean).collect()} == {100.0}
    old = clean.withColumn("age", F.when(F.col("customer_id") == "D-1", 150.0).otherwise(F.col("age")))
    assert by(quality.check_validity(old), "metric")["validity_age"]["value"] == 80.0


def test_consistency(clean):
    raw_gender = clean.withColumn("gender", F.when(F.col("age") == 34, "M").otherwise(F.col("gender")))
    found = by(quality.check_consistency(raw_gender), "metric")
    assert found["consistency_gender_categories"]["value"] == 80.0
    assert found["consistency_state_format"]["value"] == 100.0
    odd = clean.withColumn("purchase_count", F.lit(0)).withColumn("state", F.lit("xx"))
    assert by(quality.check_consistency(odd), "metric")["consistency_purchase_vs_spent"]["value"] == 0.0
    strict = by(quality.check_consistency(odd, states=["SP", "RJ"]), "metric")
    assert strict["consistency_state_format"]["value"] == 0.0


def test_report_and_score(clean):
    report = quality.dq_report(clean)
    assert report.columns == ["metric", "value", "status", "description"]
    last = report.collect()[-1]
    assert (last.metric, last.value, last.status) == ("accuracy_note", None, "N/A")
    assert quality.dq_score(report).first().score >= 90


def test_report_on_an_empty_table(clean):
    report = by(quality.dq_report(clean.limit(0)), "metric")
    assert report["completeness_age"]["value"] == 0.0 and report["uniqueness_customer_id"]["value"] == 0.0
    assert report["validity_email"]["value"] is None and report["validity_email"]["status"] == "CRÍTICO"


def test_known_scores(spark):
    """Published values: 19 metrics of the raw table, mean 89.39."""
    values = [100.0] * 3 + [96.06, 100.0, 95.14, 100.0, 100.0, 94.13, 100.0, 100.0, 92.25, 96.57, 94.59, 92.25, 94.13, 1.07, 42.3, 100.0]
    report = spark.createDataFrame([(v,) for v in [*values, None]], "value double")
    assert quality.dq_score(report).first().score == 89.39
    assert quality.dq_score(report.limit(0)).first().score == 0.0


def test_before_and_after(raw, clean):
    change = by(quality.dq_before_after(quality.dq_report(type_customers(raw)), quality.dq_report(clean)), "metric")
    assert change["uniqueness_customer_id"]["delta"] == 36.36 and change["validity_email"]["before"] is None
    worst = quality.worst_metrics(quality.dq_report(type_customers(raw)), 2)
    assert [r.value for r in worst.collect()] == [0.0, 63.64]


def test_report_reads_the_table_once_plus_the_key(clean, tmp_path, spark):
    clean.write.parquet(str(tmp_path / "t"))
    plan = quality.dq_report(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len([s for s in scans if "struct<customer_id:string>" not in s]) == 1
    assert len(scans) > 1


# --- imputation -------------------------------------------------------------------


def gaps(spark):
    data = [(1, "SP", 10.0, 20.0), (2, "SP", 30.0, None), (3, "SP", None, 40.0), (4, "RJ", None, 60.0), (5, None, None, 50.0), (6, "MG", 100.0, None)]
    return spark.createDataFrame(data, "customer_id int, state string, income double, age double")


def test_group_median_with_overall_fallback(spark):
    done = by(impute.impute_group_median(gaps(spark)), "customer_id")
    assert [done[i]["income"] for i in range(1, 7)] == [10.0, 30.0, 20.0, 30.0, 30.0, 100.0]


def test_the_table_is_scanned_twice_in_all(spark):
    """Once for all medians, once for the rows that are filled."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = gaps(spark).mapInPandas(count, gaps(spark).schema)
    done = impute.handle_missing(df.withColumn("satisfaction_score", F.col("age")).withColumn("city", F.lit("x")))
    assert done.where("age IS NULL OR income IS NULL OR satisfaction_score IS NULL").count() == 0 and seen.value == 12


def test_medians_outside_their_bracket_are_taken_anew(spark, monkeypatch):
    rng = random.Random(3)
    data = [(f"g{rng.randrange(4)}", rng.choice([None, rng.gauss(0, 9), float(rng.randrange(9))])) for _ in range(4000)]
    df = spark.createDataFrame(data, "g string, x double")
    expected = {("", True): median(x for _, x in data if x is not None)}
    expected |= {(g, False): median(x for k, x in data if k == g and x is not None) for g in ("g0", "g1", "g2", "g3")}

    def found():
        return {(r.group, r.whole): r["median"] for r in medians.exact_medians(df, ["x"], "g", ["x"]).collect()}

    assert found() == pytest.approx(expected)
    monkeypatch.setattr(medians, "BRACKET", (0.1, 0.2))
    assert found() == pytest.approx(expected)


def test_group_column_may_be_absent(spark):
    done = by(impute.impute_group_median(gaps(spark).drop("state")), "customer_id")
    assert done[3]["income"] == 30.0


def test_global_median(spark):
    done = by(impute.impute_global_median(gaps(spark), ["age", "absent"]), "customer_id")
    assert [done[i]["age"] for i in (2, 6)] == [45.0, 45.0]


def test_all_missing_stays_missing(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "customer_id int, age double")
    assert {r.age for r in impute.impute_global_median(df, ["age"]).collect()} == {None}


def test_missing_values_are_filled_and_documented(raw):
    typed = cleaning.validate_range(cleaning.convert_numeric(cleaning.standardize_column_names(raw)))
    done = impute.handle_missing(typed)
    assert done.columns == typed.columns and done.where("age IS NULL OR city IS NULL").count() == 0
    assert done.where("city = 'unknown'").count() == 1 and done.agg(F.min("age")).first()[0] > 0
    report = by(impute.missing_strategy(typed), "coluna")
    assert report["age"] == {"coluna": "age", "missing_percent": 36.36, "estrategia": "mediana global (45.0)"}
    assert report["income"]["estrategia"] == "mediana por grupo (state), fallback mediana global"


# --- profiling ----------------------------------------------------------------------


def test_profile(raw):
    df = cleaning.standardize_column_names(raw)
    lost = ["city", "email", "gender", "satisfaction_score", "signup_date", "state"]
    assert rows(profile.missing_summary(df)) == [(c, 1, 9.09) for c in lost]
    assert by(profile.cardinality(df))["customer_id"]["distinct_count"] == 7
    table = by(profile.table_profile(df))["age"]
    assert (table["row_count"], table["column_count"], table["data_type"], table["position"]) == (11, 12, "string", 4)
    assert rows(profile.value_counts(df, "gender"))[0] == ("M", 3)
    assert rows(profile.invalid_range_values(df)) == [("130", 2), ("16", 1)]
    assert rows(profile.value_shares(df, "gender", top=1)) == [("M", 3, 30.0)]
    assert [r.value for r in profile.distinct_values(df, "state").collect()] == ["AM", "Atlantis", "ES", "PA", "Pernambuco", "RN"]


def test_text_summary_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "x string, y string")
    found = by(profile.describe_text(df))
    assert found["x"] == {"column": "x", "count": 4, "unique": 2, "top": "a", "freq": 2}
    assert (found["y"]["count"], found["y"]["top"]) == (0, None)
    assert rows(profile.cardinality(df)) == [("x", 2), ("y", 0)]
