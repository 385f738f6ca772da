"""Every registered query against its SQL on DuckDB, and a row count for those without one."""

from __future__ import annotations

import os

import oracle
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    query, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert query(spark, SF).columns
        query(spark, SF).collect()
    else:
        difference = oracle.compare(spark, con, SF, query, sql)
        assert difference is None, difference


def test_entry(spark):
    df = entry.entry(spark)
    assert "step_0_users" in df.columns and df.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
