"""Compare registered Spark queries with their DuckDB oracle statements.

Usage: python tests/oracle_check.py [SF_DIR] [name ...]

Per query: row count, column names, and the multiset of rows, compared
exactly (``repr`` of every value: float bits, decimal scale, timestamps);
``strict=False`` normalises floats to 9 significant digits instead. Prints one
line per query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows_of(cols, rows, strict=True):
    """Multiset of rows, columns in name order. ``strict`` compares ``repr`` of
    every value (exact float bits, decimal scale, timestamps); otherwise values
    are normalised by ``norm``."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    f = repr if strict else norm
    return Counter(tuple(f(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir, names=None, verbose=True, strict=True):
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = []
    for name in names or sorted(qs):
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        if name not in sqls:
            if verbose:
                print(f"{name:32s} rows-only  spark={len(s_rows)}")
            continue
        cur = con.execute(sqls[name])
        d_cols = [c[0] for c in cur.description]
        d_rows = cur.fetchall()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_n = len(s_rows) == len(d_rows)
        sa, da = rows_of(s_cols, s_rows, strict), rows_of(d_cols, d_rows, strict)
        ok_v = ok_cols and sa == da
        status = "OK" if (ok_cols and ok_n and ok_v) else "MISMATCH"
        if verbose:
            print(f"{name:32s} {status:8s} spark={len(s_rows)} duck={len(d_rows)}")
        if status != "OK":
            bad.append(name)
            if verbose:
                if not ok_cols:
                    print("   cols spark", sorted(s_cols), "\n   cols duck ", sorted(d_cols))
                else:
                    print("   spark-only", list((sa - da).items())[:3])
                    print("   duck-only ", list((da - sa).items())[:3])
    return bad


if __name__ == "__main__":
    from servstar.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    bad = compare(spark, sf, sys.argv[2:] or None)
    spark.stop()
    sys.exit(1 if bad else 0)
