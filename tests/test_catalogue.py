"""Every registered query against its DuckDB oracle on the smallest tables,
plus the driver contract (entry / queries / oracle_sql)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck
from tardy.plans import catalogue

NAMES = sorted(catalogue.queries())  # those of tardy.llm have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_contract(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.count() > 0
    assert "num_flights" in df.columns and "median_dep_delay" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    assert r.get("oracle") == "none" or (r["cols_match"] and r["values_match"] and r["types_match"]
                                         and r["spark_rows"] == r["oracle_rows"]), r
    assert r["spark_rows"] > 0
