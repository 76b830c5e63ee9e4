"""Run catalogue queries in Spark and their oracle SQL in DuckDB, and compare
row count, column names and (order-insensitive) values.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(v) for v in row) for row in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
                 "timestamp": "TIMESTAMP WITH TIME ZONE"}


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    sp = sdf.toPandas()
    t1 = time.time()
    res = {"query": name, "spark_rows": len(sp), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    rel = con.sql(sql)
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    dp = rel.df()
    res["oracle_rows"] = len(dp)
    res["types_match"] = spark_types == duck_types
    if not res["types_match"]:
        res["type_diff"] = {c: (spark_types.get(c), duck_types.get(c))
                            for c in set(spark_types) | set(duck_types)
                            if spark_types.get(c) != duck_types.get(c)}
    res["cols_match"] = sorted(sp.columns) == sorted(dp.columns)
    if not res["cols_match"]:
        res["spark_only"] = sorted(set(sp.columns) - set(dp.columns))
        res["oracle_only"] = sorted(set(dp.columns) - set(sp.columns))
        return res
    a, b = _rows(sp), _rows(dp)
    res["values_match"] = a == b
    if not res["values_match"]:
        sa, sb = set(a), set(b)
        res["spark_extra"] = list(sa - sb)[:3]
        res["oracle_extra"] = list(sb - sa)[:3]
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tardy.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, con, name, q, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"query": name, "error": repr(e)[:400]}
        ok = (r.get("values_match") and r.get("types_match")
              and r["spark_rows"] == r.get("oracle_rows"))
        bad += 0 if (ok or r.get("oracle") == "none") else 1
        print(("OK  " if ok else "FAIL" if r.get("oracle") != "none" else "ROWS"), r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
