"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


SPARK_TO_DUCK = {
    "LongType": "BIGINT",
    "IntegerType": "INTEGER",
    "DoubleType": "DOUBLE",
    "StringType": "VARCHAR",
    "BooleanType": "BOOLEAN",
}


def type_diffs(sdf, rel) -> list:
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
        got = duck_types.get(f.name)
        if got != want:
            out.append((f.name, want, got))
    return out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    scols = sdf.columns
    ok_cols = sorted(scols) == sorted(dcols)
    if ok_cols:
        idx = [dcols.index(c) for c in scols]
        drows = [tuple(r[i] for i in idx) for r in drows]
    key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    s_sorted, d_sorted = sorted(srows, key=key), sorted(drows, key=key)
    tdiff = type_diffs(sdf, rel) if ok_cols else []
    same = ok_cols and s_sorted == d_sorted and not tdiff
    print(f"{name:28s} spark={len(srows):6d} duck={len(drows):6d} cols={'ok' if ok_cols else 'DIFF'} "
          f"types={'ok' if not tdiff else tdiff} values={'ok' if s_sorted == d_sorted else 'DIFF'} ({t1 - t0:.1f}s)")
    if not ok_cols:
        print("   spark cols", scols, "\n   duck cols ", dcols)
    elif not same:
        diff = [r for r in s_sorted if r not in set(d_sorted)][:3]
        diff2 = [r for r in d_sorted if r not in set(s_sorted)][:3]
        print("   spark-only", diff, "\n   duck-only ", diff2)
    return same


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    import __spark_entry__ as E
    from geotrail.config import get_session

    spark = get_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            n = fn(spark, sf_dir).count()
            print(f"{name:28s} spark={n:6d} (no oracle)")
            continue
        if not compare(spark, con, name, fn, sqls[name], sf_dir):
            bad.append(name)
    print("MISMATCH:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
