"""Dashboard datasets (C1-C5), the post-load snapshot (V1) and row counts (IO12).

Each chart query becomes a small labelled DataFrame: the aggregate is computed
on the cluster (broadcast dimension join, partial + final aggregate over the
fact), and only the label edits (prefix strip, period text, number formats)
are applied to the aggregated rows. The chart reference lines (80 % SLA,
75 % SLA, 3.5 satisfaction) are emitted as target columns with an on-target
flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.functions.expr import (
    period_label, round_half_up, strip_prefix, thousands,
)
from servstar.plans.warehouse import SOURCE_TABLES, STAR_TABLES, warehouse

# Chart reference lines.
SLA_TARGET_TREND_PCT = 80.0
SLA_TARGET_SCATTER_PCT = 75.0
SATISFACTION_TARGET = 3.5


def _flag_pct(flag: str, count_col: F.Column, digits: int) -> F.Column:
    """SUM(flag) / COUNT(x) * 100, rounded; NULL flags stay in the denominator."""
    return round_half_up(F.sum(flag).cast("double") / count_col.cast("double")
                         * F.lit(100.0), digits)


def requests_per_dept(fact: DataFrame, dim_department: DataFrame) -> DataFrame:
    d = dim_department.select("dept_key", "department_name")
    agg = (fact.select("dept_key", "fact_id").join(d, "dept_key")
           .groupBy("department_name").agg(F.count("fact_id").alias("total_requests")))
    return (agg.select(strip_prefix("department_name").alias("department_name"),
                       "total_requests", F.col("department_name").alias("_k"))
               .orderBy(F.desc_nulls_first("total_requests"), "_k").drop("_k"))


def sla_trend(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    t = dim_time.select("time_key", "year_num", "month_num", "month_name")
    agg = (fact.select("time_key", "fact_id", "sla_compliant_flag").join(t, "time_key")
           .groupBy("year_num", "month_num", "month_name")
           .agg(_flag_pct("sla_compliant_flag", F.count("fact_id"), 1).alias("sla_pct")))
    return (agg.withColumn("period", period_label("month_name", "year_num"))
               .withColumn("sla_target_pct", F.lit(SLA_TARGET_TREND_PCT))
               .withColumn("on_target", (F.col("sla_pct") >= F.lit(SLA_TARGET_TREND_PCT))
                           .cast("int"))
               .orderBy("year_num", "month_num"))


def satisfaction_vs_sla(fact: DataFrame, dim_department: DataFrame) -> DataFrame:
    d = dim_department.select("dept_key", "department_name")
    agg = (fact.where(F.col("has_survey") == 1)
           .select("dept_key", "fact_id", "satisfaction_score", "sla_compliant_flag")
           .join(d, "dept_key").groupBy("department_name")
           .agg(round_half_up(F.avg(F.col("satisfaction_score").cast("double")), 2)
                .alias("avg_satisfaction"),
                _flag_pct("sla_compliant_flag", F.count("fact_id"), 1).alias("sla_pct"),
                F.count("fact_id").alias("total_requests")))
    on_target = ((F.col("sla_pct") >= F.lit(SLA_TARGET_SCATTER_PCT))
                 & (F.col("avg_satisfaction") >= F.lit(SATISFACTION_TARGET)))
    return agg.select(strip_prefix("department_name").alias("department_name"),
                      "avg_satisfaction", "sla_pct", "total_requests",
                      F.lit(SLA_TARGET_SCATTER_PCT).alias("sla_target_pct"),
                      F.lit(SATISFACTION_TARGET).alias("satisfaction_target"),
                      on_target.cast("int").alias("on_target"))


def resolution_vs_sla(fact: DataFrame, dim_department: DataFrame) -> DataFrame:
    d = dim_department.select("dept_key", "department_name")
    agg = (fact.select("dept_key", "resolution_minutes", "sla_hours_allowed")
           .join(d, "dept_key").groupBy("department_name")
           .agg(round_half_up(F.avg(F.col("resolution_minutes").cast("double")) / F.lit(60.0), 1)
                .alias("avg_hours"),
                round_half_up(F.avg(F.col("sla_hours_allowed").cast("double")), 1)
                .alias("sla_hours")))
    return (agg.select(strip_prefix("department_name").alias("department_name"),
                       "avg_hours", "sla_hours", F.col("department_name").alias("_k"))
               .orderBy(F.desc_nulls_first("avg_hours"), "_k").drop("_k"))


def kpi_tiles(fact: DataFrame) -> DataFrame:
    """Four headline numbers in one global aggregate, plus their display text."""
    agg = fact.agg(
        F.count(F.lit(1)).alias("total_requests"),
        _flag_pct("sla_compliant_flag", F.count(F.lit(1)), 1).alias("sla_compliance_pct"),
        round_half_up(F.avg(F.when(F.col("has_survey") == 1,
                                   F.col("satisfaction_score").cast("double"))), 2)
        .alias("avg_satisfaction"),
        round_half_up(F.avg(F.col("resolution_minutes").cast("double")) / F.lit(60.0), 1)
        .alias("avg_resolution_hours"))
    return agg.select(
        "*",
        thousands("total_requests").alias("total_requests_text"),
        F.concat(F.col("sla_compliance_pct").cast("string"), F.lit("%"))
        .alias("sla_compliance_text"),
        F.concat(F.col("avg_satisfaction").cast("string"), F.lit(" / 5.0"))
        .alias("avg_satisfaction_text"),
        F.concat(F.col("avg_resolution_hours").cast("string"), F.lit(" hrs"))
        .alias("avg_resolution_text"))


def load_snapshot(fact: DataFrame) -> DataFrame:
    """V1: avg resolution hours, SLA %, avg satisfaction (surveyed), fact rows."""
    return fact.agg(
        round_half_up(F.avg(F.col("resolution_minutes").cast("double")) / F.lit(60.0), 2)
        .alias("avg_resolution_hours"),
        _flag_pct("sla_compliant_flag", F.count(F.lit(1)), 2).alias("sla_compliance_pct"),
        round_half_up(F.avg(F.when(F.col("has_survey") == 1,
                                   F.col("satisfaction_score").cast("double"))), 2)
        .alias("avg_satisfaction"),
        F.count(F.lit(1)).alias("total_rows"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """IO12: one (table_name, row_count) row per table; each count is a
    map-side partial count, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- registry adapters -----------------------------------------------------------
def mart_requests_per_dept(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return requests_per_dept(wh.fact_service_requests, wh.dim("dim_department"))


def mart_sla_trend(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return sla_trend(wh.fact_service_requests, wh.dim("dim_time"))


def mart_satisfaction_vs_sla(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return satisfaction_vs_sla(wh.fact_service_requests, wh.dim("dim_department"))


def mart_resolution_vs_sla(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return resolution_vs_sla(wh.fact_service_requests, wh.dim("dim_department"))


def mart_kpi_tiles(spark, sf_dir):
    return kpi_tiles(warehouse(spark, sf_dir).fact_service_requests)


def load_snapshot_q(spark, sf_dir):
    return load_snapshot(warehouse(spark, sf_dir).fact_service_requests)


def load_row_counts(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return row_counts({n: wh.table(n) for n in SOURCE_TABLES + STAR_TABLES})
