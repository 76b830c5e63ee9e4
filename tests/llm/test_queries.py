"""Every registered query of the subpackage on the smallest tables, against its DuckDB SQL where it has one."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck
from tardy.llm.queries import ORACLE_SQL, QUERIES


def test_registered():
    assert QUERIES.keys() <= E.queries().keys() and "pipeline" in E.queries()
    assert ORACLE_SQL.keys() <= QUERIES.keys() and ORACLE_SQL.keys() <= E.oracle_sql().keys()
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, len(QUERIES) + 1))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    r = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE_SQL.get(name), SF_SMALL)
    assert r["spark_rows"] > 0
    assert name not in ORACLE_SQL or (r["cols_match"] and r["values_match"] and r["types_match"]), r


NATIVE = ("op2_license_scan", "op10_mix_sources")


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
