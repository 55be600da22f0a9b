"""Compare registered queries with their SQL on DuckDB: names, types, row count and values.

Queries with SQL must also be planned without cross joins and without Python.
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb

SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view \"{name}\" as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0 if value else 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in r) for r in rows), key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


def compare(spark, con, fn, sql: str, sf_dir: str, python: bool = False) -> list[str]:
    """Differences between the query and its SQL; empty when they agree."""
    out = fn(spark, sf_dir)
    text = out._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", *(() if python else ("Python", "InPandas"))):
        if unwanted in text:
            return [f"the plan contains {unwanted}"]
    names = sorted(out.columns)
    mine = _sorted(out.select(*[f"`{c}`" for c in names]).collect())
    rel = con.sql(sql)
    theirs_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    problems = []
    if names != sorted(rel.columns):
        return [f"columns {names} != {sorted(rel.columns)}"]
    for c, t in out.dtypes:
        if SPARK_TYPES.get(t, t) != theirs_types[c]:
            problems.append(f"type of {c}: {t} != {theirs_types[c]}")
    order = [rel.columns.index(c) for c in names]
    theirs = _sorted([tuple(r[i] for i in order) for r in rel.fetchall()])
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} != {len(theirs)}")
    if not mine:
        problems.append("no rows")
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        problems.append(f"{len(bad)} of {len(mine)} rows differ, e.g. {names}\n    spark {bad[0][0]}\n    sql   {bad[0][1]}")
    return problems


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tidecast.plans.catalog import WITH_PYTHON
    from tidecast.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                n = fn(spark, folder).count()
                found = [] if n else ["no rows"]
                note = f"rows {n}"
            else:
                found, note = compare(spark, con, fn, sql, folder, name in WITH_PYTHON), "sql"
        except Exception as error:  # noqa: BLE001 - report and go on
            found, note = [f"{type(error).__name__}: {str(error)[:1500]}"], "error"
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:28s} {time.time() - start:6.1f}s {note}", flush=True)
        for f in found:
            print("    " + f, flush=True)
    print("failed:", failed)
    spark.stop()
