"""Queries of this part whose whole result SQL can express, against that SQL."""

import pytest

from fieldglass.llm.oracles import ORACLES
from fieldglass.llm.queries import QUERIES
from oracle import compare, connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name], ORACLES[name], spark, SF, duck) is None
