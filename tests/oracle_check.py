"""Compare every registered query with its DuckDB oracle (as the driver does).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: name, rows spark/oracle, schema match, value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    if sql is None:
        return dict(name=name, spark_rows=len(s_rows), oracle_rows=None, cols=None, values=None, sec=t_spark)
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    cols_ok = sorted(s_cols) == sorted(o_cols)
    vals_ok = cols_ok and rows_of(s_cols, s_rows) == rows_of(o_cols, o_rows)
    return dict(name=name, spark_rows=len(s_rows), oracle_rows=len(o_rows), cols=cols_ok,
                values=vals_ok, sec=round(t_spark, 2), s_cols=s_cols, o_cols=o_cols,
                s_rows=s_rows, o_rows=o_rows)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from sacctlens.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, name, fn, sql.get(name), sf_dir, con)
        except Exception as exc:  # report and continue
            print(f"{name:28s} ERROR {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        ok = r["values"] in (True, None)
        bad += not ok
        print(f"{name:28s} rows {r['spark_rows']}/{r['oracle_rows']} cols={r['cols']} "
              f"values={r['values']} {r['sec']}s")
        if not ok and r.get("cols") is not None:
            if not r["cols"]:
                print("   spark :", r["s_cols"])
                print("   oracle:", r["o_cols"])
            else:
                a = rows_of(r["s_cols"], r["s_rows"])
                b = rows_of(r["o_cols"], r["o_rows"])
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                for x, y in diff:
                    print("   spark :", x)
                    print("   oracle:", y)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
