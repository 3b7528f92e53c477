"""Command line: ``python -m servstar <command> --tables DIR [...]``.

* ``load``   — build and store the warehouse, print row counts and the
               post-load snapshot (V1);
* ``kpis``   — write the four KPI result files (frame variants, header CSV,
               one file each) to ``--out`` and print the KPI 1 preview;
* ``stream`` — publish the event messages, drain them through the streaming
               consumer and print the sorted summaries (ST8).

On a cluster, ``spark.checkpoint.dir`` must name a shared folder; the stored
tables go there, or with ``--root`` to a folder from which later commands take them.
"""

from __future__ import annotations

import argparse

from servstar.session import build_session

KPI_FILES = {
    "kpi1_resolution.csv": "kpi1_resolution_frame",
    "kpi2_sla_compliance.csv": "kpi2_sla_frame",
    "kpi3_satisfaction.csv": "kpi3_satisfaction_frame",
    "kpi4_monthly_trend.csv": "kpi4_trend_frame",
}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="servstar")
    ap.add_argument("command", choices=["load", "kpis", "stream"])
    ap.add_argument("--tables", required=True, help="folder of the given parquet tables")
    ap.add_argument("--out", help="output folder for kpis")
    ap.add_argument("--root", help="folder that keeps the warehouse for later commands on the same tables")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession
    existing = SparkSession.getActiveSession()
    spark = build_session(args.master)
    if args.root:
        spark.conf.set("spark.servstar.root", args.root)
    from servstar.registry import QUERIES

    if args.command == "load":
        from servstar.sources.tables import fetch_one
        QUERIES["load_row_counts"](spark, args.tables).show(truncate=False)
        snap = fetch_one(QUERIES["load_snapshot"](spark, args.tables))
        print(f"Overall avg resolution time : {snap.avg_resolution_hours} hours")
        print(f"Overall SLA compliance      : {snap.sla_compliance_pct}%")
        print(f"Overall avg satisfaction    : {snap.avg_satisfaction} / 5.0")
        print(f"Total fact rows             : {snap.total_rows}")
    elif args.command == "kpis":
        if not args.out:
            ap.error("kpis needs --out")
        from servstar.sources.tables import write_csv
        for fname, name in KPI_FILES.items():
            write_csv(QUERIES[name](spark, args.tables), f"{args.out.rstrip('/')}/{fname}")
        QUERIES["kpi1_preview"](spark, args.tables).show(truncate=False)
    else:
        for name in ("stream_total", "stream_by_department", "stream_by_priority"):
            QUERIES[name](spark, args.tables).show(truncate=False)
    if existing is None:  # stop only a session this command started
        spark.stop()


if __name__ == "__main__":
    main()
