import unicodedata
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.conftest import rows

from dqspark.functions import dates, numbers, text
from dqspark.operators import clean as ops
from dqspark.plans.customers import clean_customers


def values(spark, rule, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("t"))).collect()]


def test_column_names_become_snake_case(raw):
    assert ops.standardize_column_names(raw).columns == [
        "customer_id", "customer_name", "email", "age", "gender", "city", "state", "signup_date",
        "income", "purchase_count", "total_spent", "satisfaction_score",
    ]


def test_column_names_that_would_clash_are_refused(spark):
    with pytest.raises(ValueError, match="share a name"):
        ops.standardize_column_names(spark.range(1).selectExpr("id AS `A b`", "id AS `a_b `"))


def test_spaces_are_trimmed_and_collapsed(spark):
    assert values(spark, text.collapse_spaces, "  Pedro   Alves  ", "a\t b\x1fc", None) == ["Pedro Alves", "a b c", None]


def test_title_case_after_any_uncased_character(spark):
    got = values(spark, text.title_case, "ÍRIS FALCÃO", "d'avila ana-maria", "o 3rd")
    assert got == ["Íris Falcão", "D'Avila Ana-Maria", "O 3Rd"]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(max_size=8), min_size=400, max_size=400))
def test_accents_are_stripped_as_by_decomposition(spark, samples):
    samples += ["Não binário", "ﬁﬀ½", "한국", "é", "Ｆｕｌｌ", "ΐ"]
    expected = ["".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)) for s in samples]
    assert values(spark, text.strip_accents, *samples) == expected


def test_gender_variants(raw, spark):
    done = ops.standardize_gender(ops.standardize_column_names(raw))
    assert [r.gender for r in done.collect()] == [
        "feminino", "masculino", "outro", None, "masculino", "feminino", "feminino", *["masculino"] * 4,
    ]
    odd = spark.createDataFrame([(1, "Não Binário"), (2, "xyz"), (3, None), (4, " N/I ")], "i int, gender string")
    assert [r.gender for r in ops.standardize_gender(odd).orderBy("i").collect()] == ["outro", "outro", None, "outro"]


def test_state_variants(raw, spark):
    done = ops.standardize_state(ops.standardize_column_names(raw))
    assert {r.state for r in done.collect()} == {"PE", "unknown", None, "PA", "ES", "AM"}
    odd = spark.createDataFrame([(1, "SÃO PAULO "), (2, "Atlantis"), (3, None)], "i int, state string")
    assert [r.state for r in ops.standardize_state(odd).orderBy("i").collect()] == ["SP", "unknown", None]


def test_large_mappings_are_joined(spark):
    df = spark.createDataFrame([(1, "K7"), (2, "nope"), (3, None)], "i int, c string")
    mapping = {f"k{i}": f"v{i}" for i in range(1000)}
    assert [r.c for r in ops.map_category(df, "c", mapping, "?").orderBy("i").collect()] == ["v7", "?", None]


def test_unmapped_values_are_audited(spark):
    df = spark.createDataFrame([("Xyz",), ("xyz ",), ("m",), (None,)], "gender string")
    assert rows(ops.unmapped_categories(df, "gender", {"m": "masculino"})) == [("xyz", 2)]


def test_email_is_normalised_and_flagged(raw, spark):
    done = ops.clean_email(ops.standardize_column_names(raw))
    assert [r.email for r in done.collect()].count("davi@exemplo.org") == 3
    assert [r.customer_id for r in done.collect() if not r.email_valido] == ["C-12", "C-13"]
    odd = spark.createDataFrame([(1, "a@b"), (2, None), (3, "u@mail. com"), (4, "a@@b.c")], "i int, email string")
    assert [r.email_valido for r in ops.clean_email(odd).orderBy("i").collect()] == [False, False, True, False]


MONEY = {
    "4500": 4500.0, "5.200": 5200.0, "R$ 6.300,00": 6300.0, "R$  6.300,50 ": 6300.5, "5.2": 5.2,
    "0.125": 125.0, "1,234.56": 1.23456, "1,234,567": None, "1.234.56": None, "-12,5": -12.5, "1 000": 1000.0,
    "": None, " ": None, "R$": None, "nan": None, "inf": None, "1d": None, "1_000": None, "1e3": 1000.0, "abc": None,
}


def test_money_layouts(spark):
    assert values(spark, numbers.parse_money, *MONEY, None) == [*MONEY.values(), None]


def test_plain_numbers(spark):
    assert values(spark, numbers.to_numeric, "30", " 4.5 ", "1,5", "x", "", ".5", "1.", "+2", "1f", "0x1A") == [
        30.0, 4.5, None, None, None, 0.5, 1.0, 2.0, None, None,
    ]


def test_numeric_columns(raw, spark):
    done = ops.convert_numeric(ops.standardize_column_names(raw))
    assert [r.income for r in done.collect()] == [
        4100.0, 3250.75, 125.0, None, 2600.0, 5200.0, 5300.0, 1800.0, 1800.0, 3250.75, 3250.75,
    ]
    assert [(r.total_spent, r.purchase_count) for r in done.collect()[1:4]] == [(990.1, 8), (77.0, 2), (1000.0, 4)]
    types = dict(done.dtypes)
    assert (types["income"], types["purchase_count"], types["age"]) == ("double", "bigint", "double")
    halves = spark.createDataFrame([("0.5",), ("1.5",), ("2.5",), ("x",)], "purchase_count string")
    assert [r[0] for r in ops.convert_numeric(halves).collect()] == [0, 2, 2, None]


DATES = {
    "2024-01-10": date(2024, 1, 10), "10/01/2024": date(2024, 1, 10), "15-03-2024": date(2024, 3, 15),
    "2024/02/15": date(2024, 2, 15), " 2024-1-5 ": date(2024, 1, 5), "01/25/2024": date(2024, 1, 25),
    "20240131": date(2024, 1, 31), "March 5, 2024": date(2024, 3, 5), "5 Mar 2024": date(2024, 3, 5),
    "2024-01-10 08:30:00": date(2024, 1, 10), "31/02/2024": None, "not a date": None, "": None,
    "10/01/24": None, "0024-01-10": None, "3000-01-01": None,
}


def test_date_layouts(spark):
    assert values(spark, dates.parse_date, *DATES, None) == [*DATES.values(), None]


def test_timestamps_keep_their_time(spark):
    got = values(spark, dates.parse_timestamp, "2024-01-10 08:30:00", "2024-01-10T08:30", "10/01/2024", "x")
    assert got == [datetime(2024, 1, 10, 8, 30), datetime(2024, 1, 10, 8, 30), datetime(2024, 1, 10), None]


def test_date_parts(raw):
    done = ops.convert_dates(ops.standardize_column_names(raw)).collect()
    assert [r.signup_date_year for r in done[:7]] == [2021, 2022, 2022, None, 2022, None, 2023]
    assert (done[6].signup_date_month, done[6].signup_date_quarter, done[6].signup_date_weekday) == (1, 1, "Monday")


def test_ages_out_of_range_are_blanked_not_dropped(raw):
    typed = ops.convert_numeric(ops.standardize_column_names(raw))
    assert [r.age for r in ops.validate_range(typed).collect()] == [34.0, 52.0, 29.0, None, None, 45.0, 45.0, None, None, 52.0, 52.0]
    report = ops.range_report(typed).first()
    assert (report.regra, report.quantidade_invalida, report.percentual_invalido) == ("18 <= age <= 100", 3, 27.27)


def test_range_report_without_the_column_is_empty_and_typed(clean):
    report = ops.range_report(clean.drop("age"))
    assert rows(report) == [] and report.columns[2] == "quantidade_invalida"


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("x",)], "other string")
    assert rows(clean_customers(df)) == [("x",)]


def test_whole_cleaning_chain(raw):
    done = clean_customers(raw).collect()
    assert [r.customer_name for r in done[:2]] == ["Rosa D'Ávila-Lima", "Davi Couto"] and done[4].age is None
    assert (done[2].income, done[2].signup_date) == (125.0, date(2022, 7, 5))


def test_cleaning_runs_on_a_stream(spark, raw, tmp_path):
    source = str(tmp_path / "in")
    raw.toDF(*[c.lower().replace(" ", "_") for c in raw.columns]).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    query = clean_customers(stream).writeStream.format("memory").queryName("cleaned").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.table("cleaned").count() == 11
