"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import pytest

from galewire.workload.oracles import ORACLES
from galewire.workload.queries import QUERIES
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], ORACLES[name]) is None
