"""Every registered query on the smallest tables against its SQL."""

import pytest

import __spark_entry__ as entry_file
from compare import load, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_file.queries(), entry_file.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return load(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert spark_rows(QUERIES[name](spark, FOLDER)) == sql_rows(con, ORACLES[name])


def test_entry(spark):
    assert entry_file.entry(spark).count() == 1000
