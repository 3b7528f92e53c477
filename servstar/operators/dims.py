"""Dimension builders (L1-L3, L5).

Surrogate keys come from a stored key map (``operators.keys``): what has a key keeps it over
reloads, new natural keys are numbered after it. Without a map given, a dimension gets one of its own, whose keys
ascend with the natural key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar import schemas
from servstar.functions.expr import (
    monday_week_number, quarter_label, sla_category, smart_date_key, weekend_flag,
)
from servstar.operators.keys import KeyMap, keyed


def dim_department(departments: DataFrame, keys: KeyMap | None = None) -> DataFrame:
    df = keyed(departments.select("department_id", "department_code", "department_name",
                                   "department_sector"), "dept_key", "department_id", keys)
    return schemas.conform(df.withColumn("effective_date", F.current_timestamp()),
                           schemas.DIM_DEPARTMENT)


def dim_service_type(service_types: DataFrame, keys: KeyMap | None = None) -> DataFrame:
    """Copies code, name and category; the owning department is not carried."""
    df = keyed(service_types.select("service_type_id", "service_code", "service_name",
                                     "category"), "service_key", "service_type_id", keys)
    return schemas.conform(df.withColumn("effective_date", F.current_timestamp()),
                           schemas.DIM_SERVICE_TYPE)


def dim_sla(sla_definitions: DataFrame, keys: KeyMap | None = None) -> DataFrame:
    df = keyed(sla_definitions.select("sla_id", "priority_level", "sla_hours"),
                "sla_key", "sla_id", keys)
    df = df.withColumn("sla_category", sla_category("sla_hours"))
    return schemas.conform(df.withColumn("effective_date", F.current_timestamp()),
                           schemas.DIM_SLA)


def dim_time(bounds: DataFrame) -> DataFrame:
    """One row per day from ``bounds.start`` to ``bounds.end`` inclusive."""
    days = bounds.select(
        F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    df = days.select(
        smart_date_key(d).alias("time_key"),
        d,
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofmonth(d).alias("day_num"),
        monday_week_number(d).alias("week_num"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_num"),
        quarter_label(d).alias("quarter_name"),
        F.year(d).alias("year_num"),
        weekend_flag(d).alias("is_weekend"),
        F.lit(0).alias("is_holiday"),
    )
    return schemas.conform(df, schemas.DIM_TIME)
