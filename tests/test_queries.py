"""Every registered query against its oracle on the smallest tables."""

import pytest

import workload.queries  # noqa: F401
from workload.check import compare, duck
from workload.registry import ORACLES, QUERIES

from given import SF


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    assert compare(spark, con, SF, name) is None
