import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", **{"spark.driver.memory": "8g"})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a table from tuples and read one back as a list of tuples."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


def tuples(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture
def values():
    return tuples
