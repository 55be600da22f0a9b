"""Every query that SQL can express agrees with DuckDB on the whole test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect
from tidecast.plans.catalog import WITH_PYTHON

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF, name in WITH_PYTHON) == []
