"""Run registered Spark queries and their DuckDB oracle side by side.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, sorted column names and an order-insensitive multiset of
normalised rows (floats compared exactly after the query's own rounding)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    con.execute("SET TimeZone='UTC'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    t1 = time.time()
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    d_cols0 = [d[0] for d in res.description]
    d_cols, d_rows = rows_of(d_cols0, res.fetchall())
    t2 = time.time()
    ok = s_cols == d_cols and s_rows == d_rows
    info = {"name": name, "status": "ok" if ok else "MISMATCH", "rows": len(s_rows), "oracle_rows": len(d_rows),
            "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if not ok:
        if s_cols != d_cols:
            info["cols"] = (s_cols, d_cols)
        else:
            ss, dd = set(s_rows), set(d_rows)
            info["only_spark"] = sorted(ss - dd, key=repr)[:3]
            info["only_duck"] = sorted(dd - ss, key=repr)[:3]
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from nextcat.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            info = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            info = {"name": name, "status": "ERROR", "error": repr(e)[:500]}
        bad += info["status"] in ("MISMATCH", "ERROR")
        print(info, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
