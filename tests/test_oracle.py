"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from fieldglass.checks.registry import ORACLES, QUERIES
from oracle import compare, connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connection(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name], ORACLES[name], spark, SF, duck) is None
