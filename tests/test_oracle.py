"""Every registered query against its SQL oracle, and the driver contract."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, connect
from workloads.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 36
