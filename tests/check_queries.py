"""Run queries against their SQL twins: python tests/check_queries.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, "nan" if math.isnan(v) else repr(v))
    return (3, str(v))


def compare(spark, con, folder: str, name: str, plan, sql: str | None) -> str:
    df = plan(spark, folder)
    cols = sorted(df.columns)
    got = sorted(tuple(_key(r[c]) for c in cols) for r in df.collect())
    if sql is None:
        return f"rows {len(got)}" if got else "EMPTY"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"COLUMNS {cols} {sorted(names)}"
    at = [names.index(c) for c in cols]
    want = sorted(tuple(_key(r[i]) for i in at) for r in cur.fetchall())
    if len(got) != len(want):
        return f"ROWS {len(got)} {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"VALUES {len(bad)} of {len(got)}: {[(c, a, b) for c, a, b in zip(cols, *bad[0]) if a != b]}"
    return f"ok {len(got)}" if got else "EMPTY"


if __name__ == "__main__":
    from tidemark import catalog
    from tidemark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), connect(folder)
    plans, sqls = catalog.spark_queries(), catalog.sql_queries()
    for name in sys.argv[2:] or plans:
        t = time.time()
        try:
            res = compare(spark, con, folder, name, plans[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            res = f"ERROR {type(e).__name__} {str(e)[:400]}"
        print(f"Q {name:32s} {time.time() - t:6.1f}s {res}", flush=True)
