"""Compare registered queries with their SQL on DuckDB.

Run as a script: python tests/oracle.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, datetime.datetime)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):  # arrays and structs
        return tuple(map(_plain, v))
    return bytes(v) if isinstance(v, bytearray) else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def differences(spark, con, sf_dir: str, fn, sql: str | None) -> list[str]:
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return [] if got else ["no rows"]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = rows_of(names, cur.fetchall())
    out = []
    if sorted(names) != sorted(df.columns):
        out.append(f"columns {sorted(df.columns)} against {sorted(names)}")
    for name, dtype in df.dtypes:
        if name in types and TYPES.get(dtype) != types[name]:
            out.append(f"type of {name}: {dtype} against {types[name]}")
    if got != want:
        out.append(f"{sum(got.values())} rows against {sum(want.values())}")
        out.append(f"only here: {list((got - want).items())[:3]}")
        out.append(f"only there: {list((want - got).items())[:3]}")
    return out


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from loomwork.session import local_session

    spark = local_session("oracle", 8)
    con = connect(sf_dir)
    sqls, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            bad = differences(spark, con, sf_dir, fn, sqls.get(name))
        except Exception as e:  # report and go on
            bad = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(bad)
        kind = "sql" if name in sqls else "rows"
        print(f"{'FAIL' if bad else 'ok'} {name} [{kind}] {time.time() - start:.1f}s", *bad, sep="\n   " if bad else " ", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
