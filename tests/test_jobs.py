"""Sources, sinks, the batch job and the driver contract."""

import csv as pycsv
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.conftest import RAW_COLUMNS, RAW_ROWS, by, rows

import __spark_entry__ as contract
from checks.compare import connect, difference
from dqspark.plans import batch
from dqspark.session import Scratch, scratch_dir, stage
from dqspark.sources import csv

SF = "/root/testdata/sf0.001"


def write_csv(path, header, lines):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = pycsv.writer(f)
        out.writerow(header)
        out.writerows([["" if v is None else v for v in line] for line in lines])
    return str(path)


def test_raw_scan_keeps_text_and_nulls_the_missing_tokens(spark, tmp_path):
    path = write_csv(tmp_path / "raw.csv", ["a", "b c"], [["007", "NA"], [" x ", 'say "hi", ok'], ["n/a", "None "], ["", "5.200"]])
    df = csv.load_raw(spark, path)
    assert df.columns == ["a", "b c"] and {t for _, t in df.dtypes} == {"string"}
    assert rows(df) == [("007", None), (" x ", 'say "hi", ok'), (None, "None "), (None, "5.200")]


def test_raw_scan_of_a_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv.load_raw(spark, str(tmp_path / "none.csv"))


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(" padded ", "", 'q"uo,te'), ("é", None, "x")], "a string, b string, c string")
    csv.save_frame(df, str(tmp_path / "out" / "t"), single_file=True)
    csv.save_frame(df, str(tmp_path / "out" / "t"), single_file=True)
    files = list((tmp_path / "out" / "t").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text(encoding="utf-8").splitlines()[0] == "a,b,c"
    assert sorted(rows(csv.load_raw(spark, str(tmp_path / "out" / "t")))) == [(" padded ", None, 'q"uo,te'), ("é", None, "x")]


def staged_folders(spark):
    return set(Path(scratch_dir(spark).removeprefix("file:")).glob("dqspark-*"))


def test_a_scope_frees_its_own_tables_and_no_others(spark):
    before = staged_folders(spark)
    kept = stage(spark.range(100).withColumn("x", F.rand(1)))
    outside = staged_folders(spark) - before
    with Scratch(spark):
        inner = stage(spark.range(5))
        with Scratch(spark):
            assert stage(spark.range(7)).count() == 7
        assert inner.count() == 5
    assert staged_folders(spark) - before == outside and len(outside) == 1
    assert kept.count() == 100


def test_a_failing_job_leaves_nothing(spark, tmp_path):
    before = staged_folders(spark)
    source = write_csv(tmp_path / "raw.csv", RAW_COLUMNS, RAW_ROWS)
    with pytest.raises(Exception):
        batch.run(spark, source, "/proc/no such place")
    assert staged_folders(spark) == before


def test_line_breaks_inside_quotes_belong_to_the_field(spark, tmp_path):
    path = write_csv(tmp_path / "raw.csv", ["a", "b"], [["one\nmore", "x, y"], ["two", 'say "hi"\n\nbye']])
    assert rows(csv.load_raw(spark, path)) == [("one\nmore", "x, y"), ("two", 'say "hi"\n\nbye')]


def test_missing_tokens_of_processed_data(spark, tmp_path):
    columns = ["customer_id", "customer_name", "email", "age", "gender"]
    everything = csv.T.StructType.fromDDL(csv.PROCESSED_SCHEMA).names
    line = dict(zip(columns, ["C-1", "N/A", "NA", "NA", "n/a"]))
    path = write_csv(tmp_path / "done.csv", everything, [[line.get(c, "") for c in everything]])
    row = csv.load_processed(spark, path).first()
    assert row.customer_id == "C-1" and {v for k, v in row.asDict().items() if k != "customer_id"} == {None}
    csv.load_processed(spark, path).write.parquet(str(tmp_path / "p"))
    assert csv.load_processed(spark, str(tmp_path / "p"), "parquet").first() == row


def test_batch_writes_every_report(spark, tmp_path):
    source = write_csv(tmp_path / "raw.csv", RAW_COLUMNS, RAW_ROWS)
    written = batch.run(spark, source, str(tmp_path / "out"))
    fourteen = {
        "customers_clean", "data_quality_report_raw", "data_quality_report", "descriptive_statistics",
        "correlation_matrix", "correlation_matrix_spearman", "top_correlated_pairs_pearson",
        "top_correlated_pairs_spearman", "outliers_report", "statistical_tests", "fuzzy_duplicates_report",
        "deduplication_summary", "missing_values_strategy", "age_validation_report",
    }
    assert fourteen <= set(written)

    def read(name):
        return spark.read.option("header", True).option("escape", '"').csv(written[name])

    done = csv.load_processed(spark, written["customers_clean"])
    assert done.count() == 7 and done.where("age IS NULL OR customer_segment IS NULL").count() == 0
    assert [r.quantidade for r in read("deduplication_summary").collect()] == ["11", "2", "2", "7", "1"]
    assert by(read("age_validation_report"), "coluna")["age"]["quantidade_invalida"] == "3"
    raw_report, report = by(read("data_quality_report_raw"), "metric"), by(read("data_quality_report"), "metric")
    assert (len(raw_report), len(report)) == (20, 27)
    assert raw_report["uniqueness_customer_id"]["value"] == "63.64" and "validity_email" not in raw_report
    assert {r.etapa for r in read("deduplication_summary").collect()} >= {"Registros originais (RAW)"}
    assert read("descriptive_statistics").columns[:3] == ["column", "count", "mean"]
    assert read("charts/customers_by_month").count() == 5


def test_entry(spark):
    report = contract.entry(spark)
    assert report.count() == 27 and "delta" in report.columns


def test_every_query_has_an_oracle():
    own = {k for k in contract.queries() if k != "pipeline" and not k.startswith("op")}
    assert own == {k for k in contract.oracle_sql() if k != "pipeline" and not k.startswith("op")}


LIGHT = (
    "title_case_name", "norm_key", "clean_email", "std_state", "parse_money", "date_parts", "range_report",
    "handle_missing", "dq_report", "key_duplicates", "dedup_by_key", "fuzzy_part_names", "describe_numeric",
    "segment_summary", "avg_rank", "test_welch_t", "kde_grid",
)


@pytest.mark.parametrize("name", LIGHT)
def test_queries_agree_with_their_oracle(spark, name):
    found = contract.queries()[name](spark, SF)
    assert difference(found, connect(SF), contract.oracle_sql()[name], name) is None


def test_orders_of_one_value_are_compared_by_their_ranks(spark, tmp_path):
    """10.02 with key 2 and 10.00 with key 2,000,002 have one value; the order with key 7 comes twice."""
    orders = [(1, 10.01), (5001, 99.5), (10001, 9.0), (2, 10.02), (2_000_002, 10.0), (3, 10.05), (3_000_003, 10.02)]
    orders += [(7, 50.0), (7, 50.0), (4, 120.25), (8, 8.0), (15001, 10.03)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    name = "test_mann_whitney_small"
    found = contract.queries()[name](spark, str(tmp_path))
    assert difference(found, con, contract.oracle_sql()[name], name) is None
