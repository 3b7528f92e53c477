"""Single-node comparison point: the same load and headline queries in DuckDB.

The reference publishes no timings, so this times our own DuckDB oracle SQL on
one machine: ``load`` materialises every source / star table (as the Spark
load writes them), then each headline query runs against those tables.

Usage: python tools/duckdb_baseline.py [SF_DIR] [THREADS]
Prints one JSON line shaped like bench.py's.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

STORED = ("departments", "service_catalog", "service_types", "sla_definitions",
          "service_requests", "user_surveys", "dim_department", "dim_service_type",
          "dim_sla", "dim_time", "fact_service_requests")


def main() -> None:
    import duckdb

    from bench import HEADLINE
    from servstar import oracle
    from servstar.registry import ORACLE_SQL

    sf_dir = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1").rstrip("/")
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in ("region nation customer supplier part orders lineitem events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")

    times = {}
    t0 = time.perf_counter()
    for name in STORED:
        con.execute(f"CREATE TABLE {name} AS WITH {oracle.STAR_CTES} SELECT * FROM {name}")
    times["load"] = round(time.perf_counter() - t0, 3)

    # headline queries over the materialised tables: drop the CTE prefix
    prefix = f"WITH {oracle.STAR_CTES}"
    for name in HEADLINE:
        sql = ORACLE_SQL[name]
        if sql.startswith(prefix):
            body = sql[len(prefix):].lstrip()
            sql = ("WITH " + body[1:].lstrip()) if body.startswith(",") else body
        t = time.perf_counter()
        con.execute(sql).fetchall()
        times[name] = round(time.perf_counter() - t, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "engine": "duckdb", "threads": threads,
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
