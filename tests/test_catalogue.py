"""Every catalogue query against its SQL twin."""

import os

import pytest
from compare import connect, mismatch

from formlake.plans.catalogue import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert mismatch(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None
