"""Every query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
import check

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return check.duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert ok, note


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0
