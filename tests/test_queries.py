"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
from oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# the document operators have tests of their own
QUERIES = {k: f for k, f in registry.queries().items() if k not in registry.LLM_QUERIES}
ORACLES = {k: f for k, f in registry.oracle_sql().items() if k not in registry.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    n, difference = compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert difference is None, difference
    assert n > 0


def test_entry(spark):
    assert registry.entry(spark).count() > 0
