import pytest

from tidemark.plans.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def frame(spark):
    """DataFrame of literal rows."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
