"""Corpus queries against their SQL oracles, and the registration contract."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from pseudora.llm import queries
from tools.check_oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_one_query_per_operator():
    numbers = [int(m[1]) for name in entry.queries() if (m := re.match(r"op(\d+)_", name))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()
