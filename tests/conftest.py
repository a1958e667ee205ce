"""One local session, small customer tables and helpers."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from dqspark.session import get_spark  # noqa: E402

RAW_COLUMNS = [
    "Customer ID", "Customer Name", "Email", "Age", "Gender", "City", "State", "Signup Date",
    "Income", "Purchase Count", "Total Spent", "Satisfaction Score",
]
#: One row per trap: title case inside words, odd spaces, money layouts, halves, no
#: group, no number, short years, a date that is missing and one that ties.
_COPIED = ("C-11", "Davi\u00a0 Couto ", "DAVI@exemplo.org", "52", "masc", "Natal", "RN", "2022/11/30", "R$ 3.250,75", "8", "R$ 990,10", "3.2")
RAW_ROWS = [
    ("C-10", "rosa d'ávila-lima", "rosa@exemplo.org", "34", "Feminino", "Recife", "Pernambuco", "2021-02-03", "4100", "3", "1200", "4.1"),
    _COPIED,
    ("C-12", "Otto Reis", "otto.exemplo.org", "29", "Não binário", "Belém", "Atlantis", "20220705", "0.125", "2.5", "77", "2.8"),
    ("C-13", "Nair Paes", None, "1d", None, None, None, "03/02/21", "1.234.56", "4", "1e3", None),
    ("C-14", "Otto Reiss", "otto@exemplo.org", "16", "M", "Belém", "PA", "15-08-2022", "2600", "1", "60", "5.0"),
    ("C-15", "Yara Melo", "yara@exemplo.org", "45", "F", "Vitória", "ES", None, "5200", "6", "410", "3.9"),
    ("C-15", "Yara Melo", "yara@exemplo.org", "45", "F", "Vitória", "ES", "2023-01-09", "5300", "7", "480", "3.9"),
    ("C-16", "Ugo Sá", "ugo@exemplo.org", "130", "M", "Manaus", "AM", "2020-06-01", "1800", "2", "35", "1.5"),
    ("C-16", "Ugo Sá", "ugo@exemplo.org", "130", "M", "Manaus", "AM", "2020-06-01", "1800", "5", "35", "1.5"),
    _COPIED,
    _COPIED,
]
CLEAN_SCHEMA = (
    "customer_id string, customer_name string, email string, email_valido boolean, age double, gender string, "
    "city string, state string, signup_date date, income double, purchase_count bigint, total_spent double, "
    "satisfaction_score double"
)
CLEAN_ROWS = [
    ("D-1", "Rosa D'Ávila-Lima", "rosa@exemplo.org", True, 34.0, "feminino", "Recife", "PE", "2021-02-03", 4100.0, 3, 1200.0, 4.1),
    ("D-2", "Davi Couto", "davi@exemplo.org", True, 52.0, "masculino", "Natal", "RN", "2021-02-27", 3250.75, 8, 990.1, 3.2),
    ("D-3", "Otto Reis", "otto@exemplo.org", True, 29.0, "outro", "Belém", "PA", "2022-07-05", 2600.0, 2, 77.0, 2.8),
    ("D-4", "Yara Melo", "yara@exemplo.org", True, 45.0, "feminino", "Vitória", "ES", "2023-01-09", 5300.0, 7, 480.0, 3.9),
    ("D-5", "Ugo Sá", "ugo@exemplo.org", True, 61.0, "masculino", "Santarém", "PA", "2020-06-01", 1800.0, 5, 35.0, 1.5),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW_ROWS, ", ".join(f"`{c}` string" for c in RAW_COLUMNS))


@pytest.fixture
def clean(spark):
    from datetime import date

    rows = [r[:8] + (date.fromisoformat(r[8]),) + r[9:] for r in CLEAN_ROWS]
    return spark.createDataFrame(rows, CLEAN_SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def by(df, key="column"):
    """Rows as dictionaries, by one of their columns."""
    return {r[key]: r.asDict() for r in df.collect()}
