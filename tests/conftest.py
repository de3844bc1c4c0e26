import pytest

from feedmill.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """A frame of text lines, with a number to find each again."""

    def make(texts):
        return spark.createDataFrame(list(enumerate(texts)), "n int, value string")

    return make
