"""Declared shapes of the source (request/SLA/survey) and star-schema tables.

Used to conform loaded frames (``conform``) and to read CSV / JSON without
inference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, S, D = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()
TS = T.TimestampNTZType()
MIN = T.DecimalType(10, 2)      # minutes
HRS = T.DecimalType(9, 2)       # SLA hours (days x 24 exceeds decimal(5,2))
SCORE = T.DecimalType(2, 1)     # survey scores, half-point steps


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


DEPARTMENTS = _st(("department_id", L, False), ("department_code", S, False),
                  ("department_name", S, False), ("department_sector", S, True),
                  ("created_at", TS, True))
SERVICE_TYPES = _st(("service_type_id", L, False), ("service_code", S, False),
                    ("service_name", S, False), ("department_id", L, False),
                    ("category", S, True), ("created_at", TS, True))
SLA_DEFINITIONS = _st(("sla_id", L, False), ("service_type_id", L, False),
                      ("priority_level", S, False), ("sla_hours", HRS, False),
                      ("created_at", TS, True))
SERVICE_REQUESTS = _st(("request_id", L, False), ("request_ref", S, False),
                       ("department_id", L, False), ("service_type_id", L, False),
                       ("sla_id", L, False), ("requester_name", S, True),
                       ("requester_email", S, True), ("channel", S, True),
                       ("status", S, True), ("priority", S, True),
                       ("submitted_at", TS, False), ("assigned_at", TS, True),
                       ("completed_at", TS, True), ("resolution_minutes", MIN, True),
                       ("sla_deadline", TS, True), ("sla_compliant", I, True),
                       ("notes", S, True), ("created_at", TS, True))
USER_SURVEYS = _st(("survey_id", L, False), ("request_id", L, False),
                   ("satisfaction_score", SCORE, False), ("ease_of_use_score", SCORE, True),
                   ("response_speed_score", SCORE, True), ("comments", S, True),
                   ("surveyed_at", TS, True))

DIM_DEPARTMENT = _st(("dept_key", L, False), ("department_id", L, False),
                     ("department_code", S, False), ("department_name", S, False),
                     ("department_sector", S, True), ("effective_date", T.TimestampType(), True))
DIM_SERVICE_TYPE = _st(("service_key", L, False), ("service_type_id", L, False),
                       ("service_code", S, False), ("service_name", S, False),
                       ("category", S, True), ("effective_date", T.TimestampType(), True))
DIM_TIME = _st(("time_key", I, False), ("full_date", D, False), ("day_of_week", S, True),
               ("day_num", I, True), ("week_num", I, True), ("month_num", I, True),
               ("month_name", S, True), ("quarter_num", I, True), ("quarter_name", S, True),
               ("year_num", I, True), ("is_weekend", I, True), ("is_holiday", I, True))
DIM_SLA = _st(("sla_key", L, False), ("sla_id", L, False), ("priority_level", S, False),
              ("sla_hours", HRS, False), ("sla_category", S, True),
              ("effective_date", T.TimestampType(), True))
FACT_SERVICE_REQUESTS = _st(
    ("fact_id", L, False), ("request_id", L, False), ("request_ref", S, False),
    ("dept_key", L, False), ("service_key", L, False), ("time_key", I, False),
    ("sla_key", L, False), ("channel", S, True), ("status", S, True), ("priority", S, True),
    ("resolution_minutes", MIN, True), ("sla_hours_allowed", HRS, True),
    ("sla_compliant_flag", I, True), ("sla_breach_minutes", MIN, True),
    ("satisfaction_score", SCORE, True), ("ease_of_use_score", SCORE, True),
    ("response_speed_score", SCORE, True), ("has_survey", I, True),
    ("submitted_at", TS, True), ("completed_at", TS, True),
    ("load_timestamp", T.TimestampType(), True))

# Event message (all JSON strings, as produced).
EVENT = _st(("event_id", S, True), ("event_type", S, True), ("timestamp", S, True),
            ("request_ref", S, True), ("department", S, True), ("service_type", S, True),
            ("channel", S, True), ("priority", S, True), ("requester_name", S, True),
            ("requester_email", S, True), ("status", S, True))

TABLES = {
    "departments": DEPARTMENTS, "service_types": SERVICE_TYPES,
    "sla_definitions": SLA_DEFINITIONS, "service_requests": SERVICE_REQUESTS,
    "user_surveys": USER_SURVEYS, "dim_department": DIM_DEPARTMENT,
    "dim_service_type": DIM_SERVICE_TYPE, "dim_time": DIM_TIME, "dim_sla": DIM_SLA,
    "fact_service_requests": FACT_SERVICE_REQUESTS,
}

# Declared keys (primary key first) and not-null columns, for data-quality checks.
KEYS = {
    "departments": [["department_id"], ["department_code"]],
    "service_types": [["service_type_id"], ["service_code"]],
    "sla_definitions": [["sla_id"]],
    "service_requests": [["request_id"], ["request_ref"]],
    "user_surveys": [["survey_id"], ["request_id"]],
    "dim_department": [["dept_key"]],
    "dim_service_type": [["service_key"]],
    "dim_time": [["time_key"]],
    "dim_sla": [["sla_key"]],
    "fact_service_requests": [["fact_id"]],
}


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if not f.nullable]


# Declared column defaults (value when the column is absent; as in the DDL, an
# explicit NULL stays NULL). Callables, so load times are taken per query.
DEFAULTS = {
    "departments": {"created_at": F.localtimestamp},
    "service_types": {"created_at": F.localtimestamp},
    "sla_definitions": {"created_at": F.localtimestamp},
    "service_requests": {"status": lambda: F.lit("SUBMITTED"),
                         "priority": lambda: F.lit("NORMAL"),
                         "sla_compliant": lambda: F.lit(0),
                         "created_at": F.localtimestamp},
    "user_surveys": {"surveyed_at": F.localtimestamp},
    "dim_department": {"effective_date": F.current_timestamp},
    "dim_service_type": {"effective_date": F.current_timestamp},
    "dim_sla": {"effective_date": F.current_timestamp},
    "dim_time": {"is_holiday": lambda: F.lit(0)},
    "fact_service_requests": {"has_survey": lambda: F.lit(0),
                              "load_timestamp": F.current_timestamp},
}
_TABLE_OF = {id(schema): name for name, schema in TABLES.items()}


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Select, order and cast columns to ``schema``. An absent column takes the
    table's declared default (``DEFAULTS``), else NULL."""
    if defaults is None:
        defaults = DEFAULTS.get(_TABLE_OF.get(id(schema)), {})
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
        elif f.name in defaults:
            c = defaults[f.name]()
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
