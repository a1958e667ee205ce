import pytest

from tests.llm.tables import SCHEMA, awkward_rows, make_docs


@pytest.fixture(scope="session")
def awkward(spark):
    return make_docs(spark, awkward_rows()).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
