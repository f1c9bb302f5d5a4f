"""Every registered query beside its SQL text, whole tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, message, _ = compare(spark, con, name, QUERIES[name], SQL.get(name), SF_DIR)
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
