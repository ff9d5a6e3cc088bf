"""Queries that SQL can state give what DuckDB gives; all of them are registered."""

import pytest
from oracle import connect, differences

from assayer.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = connect(FOLDER)
    assert differences(QUERIES[name](spark, FOLDER), ORACLES[name], connection) == []
    connection.close()


def test_each_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
