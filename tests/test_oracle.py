"""Every registered query against its SQL on the smallest tables."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry_points
from grainframe.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    first = entry_points.entry(spark)
    assert first.count() == 6
    assert first.columns[:2] == ["return_flag", "line_status"]
