"""Sink round trips (IO5-IO7) and the load-once guard (IO6).

* ``csv_roundtrip`` writes KPI 1 (SQL form) as a header CSV — one file, since
  it is an aggregate of at most one row per department — and reads it back with
  the declared result schema.
* ``load_if_empty_twice`` appends the fact table into a fresh table twice under
  the load-once guard: the first attempt loads, the second finds rows and
  skips. The guard reads at most one row of the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servstar.plans.kpis_sql import run_kpi
from servstar.plans.warehouse import warehouse
from servstar.session import scratch_path
from servstar.sources.tables import load_if_empty, read_csv, write_csv

KPI1_CSV_SCHEMA = T.StructType([
    T.StructField("department_name", T.StringType()),
    T.StructField("department_sector", T.StringType()),
    T.StructField("total_requests", T.LongType()),
    T.StructField("avg_resolution_hours", T.DoubleType()),
    T.StructField("min_resolution_hours", T.DoubleType()),
    T.StructField("max_resolution_hours", T.DoubleType()),
])


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "kpi1_resolution_csv")
    write_csv(run_kpi(spark, sf_dir, "kpi1_resolution_sql"), path)
    return read_csv(spark, path, KPI1_CSV_SCHEMA)


def load_if_empty_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    fact = wh.fact_service_requests
    target = scratch_path(spark, "fact_reload")
    results = []
    for attempt in (1, 2):
        loaded = load_if_empty(spark, fact, target, partition_by=None)
        results.append((attempt, int(loaded)))
    n = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("row_count"))
    out = None
    for attempt, loaded in results:
        row = n.select(F.lit(attempt).alias("attempt"), F.lit(loaded).alias("loaded"),
                       "row_count")
        out = row if out is None else out.unionByName(row)
    return out
