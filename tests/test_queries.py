"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tools.compare import difference, duck
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# Estimates, which no other engine gives alike: held against exact figures in test_sketches.
ESTIMATES = {"quality_sketches"}


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - ESTIMATES <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ESTIMATES))
def test_query(spark, con, name):
    problem, rows = difference(spark, con, SF, name)
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 150
