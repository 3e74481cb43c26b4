import pytest

from tests.oracle import agree, connect
from tripleloom.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_oracle(spark, con, name):
    agree(spark, con, QUERIES[name], ORACLES[name], SF)
