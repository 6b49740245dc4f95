import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs, with every other column null."""

    def make(pairs):
        return spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], DOCS)

    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return "/root/testdata/sf0.01"
