"""Every query that SQL can state gives what DuckDB gives on the same files."""

import pytest
from oracle import connect, differences

from assayer.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), ORACLES[name], duck) == []


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
