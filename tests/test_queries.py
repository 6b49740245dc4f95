"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

from corpusloom.queries import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

if not os.path.isdir(FOLDER):
    pytest.skip("no test tables", allow_module_level=True)

from oracle import compare, connect  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(registry()))
def test_query(spark, con, name):
    query, sql = registry()[name]
    ok, note = compare(spark, con, FOLDER, query, sql)
    assert ok, note


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
