"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Used by the tests and by ``python -m tests.oracle_check [names...]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import numpy as np
import pandas as pd

from bourse.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, (np.floating,)):
        return None if np.isnan(v) else float(v)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.date()
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(_norm(x) for x in v.values())
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], rows


def _key(row):
    return tuple((x is None, str(type(x)), x if not isinstance(x, float) else round(x, 6)) for x in row)


def _close(a, b, tol):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        try:
            a, b = float(a), float(b)
        except (TypeError, ValueError):
            return False
        return abs(a - b) <= tol * max(1.0, abs(a), abs(b))
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y, tol) for x, y in zip(a, b))
    return a == b


def compare(spark_df, sql: str, con, tol: float = 1e-9) -> dict:
    t0 = time.time()
    s_cols = spark_df.columns
    s_rec = [tuple(r) for r in spark_df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rec = rel.fetchall()
    t2 = time.time()
    out = {"spark_rows": len(s_rec), "oracle_rows": len(d_rec), "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    sc, sr = _rows(s_cols, s_rec)
    dc, dr = _rows(d_cols, d_rec)
    out["columns_match"] = sc == dc
    if sc != dc:
        out["spark_cols"] = sc
        out["oracle_cols"] = dc
        out["ok"] = False
        return out
    sr.sort(key=_key)
    dr.sort(key=_key)
    exact = sr == dr
    bad = []
    if len(sr) == len(dr):
        for a, b in zip(sr, dr):
            if not all(_close(x, y, tol) for x, y in zip(a, b)):
                bad.append((a, b))
                if len(bad) >= 3:
                    break
    out["exact"] = exact
    out["ok"] = len(sr) == len(dr) and not bad
    if bad:
        out["first_diffs"] = [
            {c: (x, y) for c, x, y in zip(sc, a, b) if not _close(x, y, tol)} for a, b in bad
        ]
    return out


def main(names):
    from __spark_entry__ import oracle_sql, queries
    from bourse.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    failed = []
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(name, "no-oracle rows=", df.count(), flush=True)
            continue
        try:
            res = compare(qs[name](spark, sf_dir), sqls[name], con)
        except Exception as e:  # noqa: BLE001 - report and continue
            res = {"ok": False, "error": repr(e)[:600]}
        if not res.get("ok"):
            failed.append(name)
        print(name, res, flush=True)
    print("FAILED:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
