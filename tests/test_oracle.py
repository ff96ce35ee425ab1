"""Every query with SQL gives the SQL's rows on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    good, note = compare(spark, connection, FOLDER, name)
    assert good or note.endswith("EMPTY"), note


def test_entry_has_rows(spark):
    panel = entry.entry(spark)
    assert panel.columns[:2] == ["ticker", "date"]
    assert not panel.isEmpty()
