"""Every registered query agrees with its SQL on whole tables."""

import os

import pytest
from oracle import actual, connect, expected

from logweir.registry import load_all

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
REGISTRY = load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY.queries))
def test_agrees_with_sql(spark, con, name):
    got_names, got = actual(REGISTRY.queries[name](spark, SF_DIR))
    want_names, want = expected(con, REGISTRY.sql[name])
    assert got_names == want_names
    assert got == want
    assert sum(want.values()) > 0
