"""KPI 1-4 as DataFrame transforms (T1-T4) and the KPI 1 preview (O6).

These follow the frame variant of each KPI where it differs from the SQL one
(SURVEY §2.13): no NULL-resolution filter in KPI 1, no category in KPI 2,
flag *means* (NULL flags leave the denominator) in KPI 3 and the trend, the
band taken on the rounded average with short labels, ties rounded to even, and NULL group keys
dropped.

Every function takes DataFrames, so the same code runs on the stored
warehouse or on hand-built frames in tests. Dimensions are joined with a
broadcast hint only through ``StoredWarehouse.dim`` (size checked there);
the aggregates are partial + final HashAggregates on tiny group domains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar.functions.expr import round_half_even, satisfaction_band
from servstar.plans.warehouse import warehouse


def _hours(agg_col) -> F.Column:
    return round_half_even(agg_col / F.lit(60.0), 2)


def _dbl(name: str) -> F.Column:
    return F.col(name).cast("double")


def _non_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Group keys that are NULL are dropped, as a pandas groupby does."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def kpi1_resolution(fact: DataFrame, dim_department: DataFrame) -> DataFrame:
    keys = ["department_name", "department_sector"]
    dept = dim_department.select("dept_key", *keys)
    df = _non_null_keys(fact.select("dept_key", "fact_id", "resolution_minutes")
                        .join(dept, "dept_key"), keys)
    return (df.groupBy(*keys).agg(
                F.count("fact_id").alias("total_requests"),
                _hours(F.avg(_dbl("resolution_minutes"))).alias("avg_resolution_hours"),
                _hours(F.min(_dbl("resolution_minutes"))).alias("min_resolution_hours"),
                _hours(F.max(_dbl("resolution_minutes"))).alias("max_resolution_hours"))
              .orderBy(F.asc_nulls_last("avg_resolution_hours"), *keys))


def kpi2_sla(fact: DataFrame, dim_time: DataFrame, dim_service_type: DataFrame) -> DataFrame:
    keys = ["year_num", "month_num", "month_name", "service_name"]
    t = dim_time.select("time_key", "year_num", "month_num", "month_name")
    s = dim_service_type.select("service_key", "service_name")
    df = _non_null_keys(fact.select("time_key", "service_key", "fact_id", "sla_compliant_flag")
                        .join(t, "time_key").join(s, "service_key"), keys)
    agg = df.groupBy(*keys).agg(
        F.count("fact_id").alias("total_requests"),
        F.coalesce(F.sum("sla_compliant_flag"), F.lit(0)).cast("long").alias("compliant_count"))
    pct = round_half_even(F.col("compliant_count").cast("double")
                        / F.col("total_requests").cast("double") * F.lit(100.0), 2)
    return (agg.withColumn("sla_compliance_pct", pct)
               .orderBy("year_num", "month_num", "service_name"))


def kpi3_satisfaction(fact: DataFrame, dim_department: DataFrame,
                      dim_service_type: DataFrame) -> DataFrame:
    keys = ["department_name", "service_name"]
    d = dim_department.select("dept_key", "department_name")
    s = dim_service_type.select("service_key", "service_name")
    surveyed = fact.where(F.col("has_survey") == 1).select(
        "dept_key", "service_key", "fact_id", "satisfaction_score", "ease_of_use_score",
        "response_speed_score", "sla_compliant_flag")
    df = _non_null_keys(surveyed.join(d, "dept_key").join(s, "service_key"), keys)
    agg = df.groupBy(*keys).agg(
        F.count("fact_id").alias("total_requests"),
        round_half_even(F.avg(_dbl("satisfaction_score")), 2).alias("avg_satisfaction"),
        round_half_even(F.avg(_dbl("ease_of_use_score")), 2).alias("avg_ease_of_use"),
        round_half_even(F.avg(_dbl("response_speed_score")), 2).alias("avg_response_speed"),
        round_half_even(F.avg(_dbl("sla_compliant_flag")) * F.lit(100.0), 2)
        .alias("sla_compliance_pct"))
    return (agg.withColumn("satisfaction_band", satisfaction_band("avg_satisfaction"))
               .orderBy(F.desc_nulls_last("avg_satisfaction"), *keys))


def kpi4_trend(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    keys = ["year_num", "month_num", "month_name", "quarter_name"]
    t = dim_time.select("time_key", *keys)
    df = _non_null_keys(fact.select("time_key", "fact_id", "sla_compliant_flag",
                                    "satisfaction_score", "resolution_minutes")
                        .join(t, "time_key"), keys)
    return (df.groupBy(*keys).agg(
                F.count("fact_id").alias("total_requests"),
                round_half_even(F.avg(_dbl("sla_compliant_flag")) * F.lit(100.0), 2)
                .alias("sla_compliance_pct"),
                round_half_even(F.avg(_dbl("satisfaction_score")), 2).alias("avg_satisfaction"),
                _hours(F.avg(_dbl("resolution_minutes"))).alias("avg_resolution_hours"))
              .orderBy("year_num", "month_num"))


def preview(df: DataFrame, n: int = 4) -> DataFrame:
    """First ``n`` rows of an already sorted result (a top-n, not a sample)."""
    return df.limit(n)


# -- registry adapters (stored warehouse of sf_dir) ---------------------------
def kpi1_resolution_frame(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return kpi1_resolution(wh.fact_service_requests, wh.dim("dim_department"))


def kpi2_sla_frame(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return kpi2_sla(wh.fact_service_requests, wh.dim("dim_time"), wh.dim("dim_service_type"))


def kpi3_satisfaction_frame(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return kpi3_satisfaction(wh.fact_service_requests, wh.dim("dim_department"),
                             wh.dim("dim_service_type"))


def kpi4_trend_frame(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return kpi4_trend(wh.fact_service_requests, wh.dim("dim_time"))


def kpi1_preview(spark, sf_dir):
    return preview(kpi1_resolution_frame(spark, sf_dir), 4)
