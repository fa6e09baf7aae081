"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from checks.compare import connect, run

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, con, name):
    problem, found, _, _ = run(spark, con, SF, name)
    assert not problem, problem


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
