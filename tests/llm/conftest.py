import pytest

from odd_documents import SCHEMA, frame, odd_rows


@pytest.fixture(scope="session")
def rows():
    return odd_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: frame(spark, rows)
