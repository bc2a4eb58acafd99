"""Run registered queries next to their SQL in DuckDB and compare.

    python tests/oracle.py [name ...]      (SF_DIR picks the data, SPARK_CONF='k=v ..' sets options)
"""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def compare(spark, con, query, sf_dir: str) -> list[str]:
    """Differences between a query and its SQL, none if they agree."""
    df = query.plan(spark, sf_dir)
    names = sorted(df.columns)
    mine = sorted(tuple(norm(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if query.sql is None:
        return [] if mine else ["no rows"]
    rel = con.sql(query.sql)
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    if sorted(rel.columns) != names:
        return [f"columns {names} against {sorted(rel.columns)}"]
    problems = []
    for f in df.schema:
        want = TYPES.get(f.dataType.simpleString())
        if want != kinds[f.name]:
            problems.append(f"{f.name}: {f.dataType.simpleString()} against {kinds[f.name]}")
    at = [rel.columns.index(n) for n in names]
    theirs = sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())
    if len(mine) != len(theirs):
        problems.append(f"{len(mine)} rows against {len(theirs)}")
    if mine != theirs:
        a, b = set(mine), set(theirs)
        problems.append(f"columns {names}; only here {sorted(a - b)[:2]}; only there {sorted(b - a)[:2]}; {len(a - b)} differ")
    if not mine:
        problems.append("no rows")
    return problems


def main(names: list[str]) -> int:
    from catalog import QUERIES
    from gaugeflow.runtime import session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    conf = dict(kv.split("=", 1) for kv in os.environ.get("SPARK_CONF", "").split() if kv)
    spark = session("oracle", "local[8]", 8, spark__driver__memory="12g", spark__checkpoint__dir=tempfile.mkdtemp())
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        spark.conf.set(k, v)
    con = duck(sf_dir)
    bad = 0
    for name, q in QUERIES.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            problems = compare(spark, con, q, sf_dir)
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
