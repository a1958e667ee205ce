"""CSV files read by many tasks, whatever the place where a block ends."""

import csv as pycsv
import random

import pytest
from pyspark.sql import functions as F

from dqspark.sources import csv
from dqspark.sources.records import Quotes

PIECES = ["a", "é", " ", ",", '"', "\n", "\r\n", "long word", "", '""', "x,\ny"]


@pytest.fixture
def small_blocks(spark):
    """Blocks of some hundred bytes, so that records often cross their ends."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield to
    for k, v in before.items():
        spark.conf.set(k, v)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("size", [300, 900])
def test_any_cut_gives_the_same_rows(spark, tmp_path, small_blocks, size):
    rng = random.Random(size)
    expected = []
    for number in range(2):
        with open(tmp_path / f"{number}.csv", "w", newline="", encoding="utf-8") as f:
            out = pycsv.writer(f, lineterminator=["\n", "\r\n"][number])
            out.writerow(["a", "b\nc" if size == 300 else "b", "d"])
            for _ in range(60):
                expected.append(tuple("".join(rng.choices(PIECES, k=rng.choice([0, 1, 2, 9]))) + "." for _ in range(3)))
                out.writerow(expected[-1])
    small_blocks(size)
    df = csv.load_raw(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 3
    assert found(df) == sorted(expected, key=repr)


def test_a_field_longer_than_blocks_and_plain_quotes(spark, tmp_path, small_blocks):
    text = "\n".join(f"line {i}" for i in range(200))
    path = tmp_path / "t.csv"
    path.write_text(f'a,b\n5" pipe,"{text}"\nx,"say ""hi"""\n\n"z\n",1\n3" x 4",2\n')
    small_blocks(150)
    expected = sorted([('5" pipe', text), ("x", 'say "hi"'), ("z\n", "1"), ('3" x 4"', "2")], key=repr)
    df = csv.load_raw(spark, str(path))
    tasks = df.select(F.spark_partition_id().alias("p"), "a").groupBy("p").count().count()
    assert found(df) == expected and tasks > 1


def test_header_across_blocks_and_header_only(spark, tmp_path, small_blocks):
    small_blocks(40)
    path = tmp_path / "h.csv"
    path.write_text('"a\n' + "a" * 100 + '",b\n1,2\n3,4\n')
    assert found(csv.load_raw(spark, str(path))) == [("1", "2"), ("3", "4")]
    (tmp_path / "only.csv").write_text("a,b\n")
    assert csv.load_raw(spark, str(tmp_path / "only.csv")).collect() == []
    (tmp_path / "empty.csv").write_text("")
    assert csv.load_raw(spark, str(tmp_path / "empty.csv")).columns == []


@pytest.mark.parametrize(
    ("line", "from_outside", "from_inside"),
    [
        ("a,b", False, True), ('a,"b', True, False), ('a,"b"', False, False), ('"a,""b', True, False),
        ('a"b,c', False, False), ('""', False, True), ('"",""', False, True), ('x","y', True, True), ('",', True, False),
    ],
)
def test_state_at_the_end_of_a_line(line, from_outside, from_inside):
    quotes = Quotes()
    assert (quotes.ends_inside(line, False), quotes.ends_inside(line, True)) == (from_outside, from_inside)


def test_bad_cells_of_processed_data_are_kept_aside(spark, tmp_path):
    names = csv.T.StructType.fromDDL(csv.PROCESSED_SCHEMA).names
    rows = [
        {"customer_id": "1", "age": "33", "signup_date": "2024-01-10", "income": "1.5", "purchase_count": "3"},
        {"customer_id": "2", "age": "abc", "signup_date": "2024/01/10", "income": "", "purchase_count": "x"},
        {"customer_id": "3", "age": "NA", "email_valido": "perhaps"},
    ]
    with open(tmp_path / "p.csv", "w", newline="") as f:
        out = pycsv.DictWriter(f, names)
        out.writeheader()
        out.writerows(rows)
    df = csv.load_processed(spark, str(tmp_path / "p.csv"), rescued="bad")
    got = {r.customer_id: r for r in df.collect()}
    assert df.columns == [*names, "bad"]
    assert got["1"].bad is None and got["1"].age == 33.0 and str(got["1"].signup_date) == "2024-01-10"
    assert got["2"].bad == {"age": "abc", "signup_date": "2024/01/10", "purchase_count": "x"} and got["2"].age is None
    assert got["3"].bad == {"email_valido": "perhaps"} and got["3"].age is None
    assert csv.load_processed(spark, str(tmp_path / "p.csv")).columns == names
