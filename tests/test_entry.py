"""Every registered query runs at sf0.001 and equals its DuckDB oracle there."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from pitlane.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["full_name", "session_id", "avg_lap_time_ms"]


def test_every_query_has_oracle_or_is_listed():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert r["match"], r
