"""Run catalogue queries on Spark and their SQL on DuckDB, compare results.

    python tools/oracle_check.py [--root /root/testdata/sf0.01] [name ...]

Prints one line per query: rows, schema and value-hash agreement.
"""

from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from doclake.sources.tables import TABLE_NAMES  # noqa: E402


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.6g}"
    if isinstance(v, (pd.Timestamp,)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, bytes):
        return v.hex()
    return str(v)


def frame_hash(rows: list[tuple], cols: list[str]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--root", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from doclake import catalog
    from doclake.session import get_session
    spark = get_session()
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    con = duck(a.root)
    bad = 0
    for name in a.names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, a.root)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # report and go on
            print(f"{name:22s} SPARK-ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"{name:22s} rows={len(srows)} (no oracle) spark={t1-t0:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = [tuple(r) for r in res.fetchall()]
        except Exception as e:
            print(f"{name:22s} SQL-ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        same_schema = sorted(scols) == sorted(dcols)
        hs, hd = frame_hash(srows, scols), frame_hash(drows, dcols)
        ok = same_schema and len(srows) == len(drows) and hs == hd
        bad += not ok
        print(f"{name:22s} {'OK  ' if ok else 'DIFF'} rows={len(srows)}/{len(drows)} "
              f"schema={'same' if same_schema else (sorted(scols), sorted(dcols))} "
              f"hash={'same' if hs == hd else 'diff'} spark={t1-t0:.1f}s")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
