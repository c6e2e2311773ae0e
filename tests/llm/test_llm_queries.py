"""Registered queries of this package against their SQL, and the guard of the entry file."""

import re

import pytest

import __spark_entry__ as entry_file
from compare import load, spark_rows, sql_rows
from eventlake.llm.oracles import ORACLES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert spark_rows(entry_file.queries()[name](spark, FOLDER)) == sql_rows(load(FOLDER), ORACLES[name])


def test_one_query_per_operator():
    numbers = [int(m[1]) for n in entry_file.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry_file.queries()
