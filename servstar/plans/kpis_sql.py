"""KPI 1-5 as SQL text over the star-schema views (Q1-Q5).

The statements give the KPI definitions of SURVEY §2.8 (columns, grouping,
filters, order), with three deliberate choices:
rounding is ``floor(x*10^n + 0.5)/10^n`` on doubles (see
``functions.round_half_up``), averages cast their decimal input to double, and
every ORDER BY states its NULL placement and a tie-break where a LIMIT depends
on it. The oracle has statements of its own (``servstar.oracle``).

Plan (Spark): scan fact (pruned to the used columns) -> broadcast hash joins
with the dimensions -> partial HashAggregate -> shuffle of at most one row per
group and task -> final HashAggregate. Nothing request-sized is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from servstar.functions.expr import round_half_up_sql as rnd
from servstar.plans.warehouse import warehouse
from servstar.sources.tables import run_sql


def _hours(aggregate: str) -> str:
    return rnd(f"{aggregate}(CAST(resolution_minutes AS DOUBLE)) / 60", 2)


def _share(part: str) -> str:
    return rnd(f"{part} / COUNT(fact_id) * 100", 2)


def _mean(score: str) -> str:
    return f"AVG(CAST({score} AS DOUBLE))"


_MET = "SUM(sla_compliant_flag)"
_MISSED = "SUM(CASE sla_compliant_flag WHEN 0 THEN 1 ELSE 0 END)"

#: What can be measured on a set of facts, by output name.
MEASURES = {
    "total_requests": "COUNT(fact_id)",
    "survey_count": "CAST(SUM(has_survey) AS BIGINT)",
    "compliant_count": f"CAST({_MET} AS BIGINT)",
    "breach_count": f"CAST({_MISSED} AS BIGINT)",
    "sla_compliance_pct": _share(_MET),
    "breach_pct": _share(_MISSED),
    "avg_resolution_hours": _hours("AVG"),
    "min_resolution_hours": _hours("MIN"),
    "max_resolution_hours": _hours("MAX"),
    "avg_satisfaction": rnd(_mean("satisfaction_score"), 2),
    "avg_ease_of_use": rnd(_mean("ease_of_use_score"), 2),
    "avg_response_speed": rnd(_mean("response_speed_score"), 2),
    "satisfaction_band": (f"CASE WHEN {_mean('satisfaction_score')} >= 4.0 THEN 'High Satisfaction' "
                          f"WHEN {_mean('satisfaction_score')} >= 3.0 THEN 'Medium Satisfaction' "
                          "ELSE 'Low Satisfaction' END"),
}
#: Dimension, its key in the fact, and the columns that KPIs group by.
DIMENSIONS = {
    "dim_department": ("dept_key", ("department_name", "department_sector")),
    "dim_service_type": ("service_key", ("service_name", "category")),
    "dim_time": ("time_key", ("year_num", "month_name", "month_num", "quarter_name")),
}


def kpi(by: tuple, measures: tuple, order: str, where: str | None = None, limit: int | None = None,
        source: str = "fact_service_requests", measured: dict | None = None, dimensions: dict | None = None) -> str:
    """The statement of a KPI: ``measures`` of the facts by the columns ``by``.
    Only the dimensions that own a column of ``by`` are joined. Another ``source`` may hold the facts, with
    expressions (``measured``) and dimensions of its own."""
    measured, dimensions = measured or MEASURES, dimensions or DIMENSIONS
    joins = [f"JOIN {dim} USING ({key})" for dim, (key, columns) in dimensions.items() if set(by) & set(columns)]
    outputs = [*by, *[f"{measured[m]} AS {m}" for m in measures]]
    lines = ["SELECT " + ", ".join(outputs), f"FROM {source}", *joins]
    lines += [f"WHERE {where}"] if where else []
    lines += ["GROUP BY " + ", ".join(by), f"ORDER BY {order}"]
    lines += [f"LIMIT {limit}"] if limit else []
    return "\n".join(lines)


#: Group columns, measures, order, filter and limit of each KPI.
KPIS = {
    "kpi1_resolution_sql": dict(
        by=("department_name", "department_sector"),
        measures=("total_requests", "avg_resolution_hours", "min_resolution_hours", "max_resolution_hours"),
        order="avg_resolution_hours ASC NULLS LAST", where="resolution_minutes IS NOT NULL"),
    "kpi2_sla_sql": dict(
        by=("year_num", "month_name", "month_num", "service_name", "category"),
        measures=("total_requests", "compliant_count", "sla_compliance_pct"),
        order="year_num, month_num, sla_compliance_pct DESC NULLS FIRST"),
    "kpi3_satisfaction_sql": dict(
        by=("department_name", "service_name"),
        measures=("total_requests", "survey_count", "avg_satisfaction", "avg_ease_of_use", "avg_response_speed",
                  "sla_compliance_pct", "satisfaction_band"),
        order="avg_satisfaction DESC NULLS FIRST", where="has_survey = 1"),
    "kpi4_trend_sql": dict(
        by=("year_num", "month_name", "month_num", "quarter_name"),
        measures=("total_requests", "sla_compliance_pct", "avg_satisfaction", "avg_resolution_hours"),
        order="year_num, month_num"),
    "kpi5_top_breach_sql": dict(
        by=("department_name",), measures=("total_requests", "breach_count", "breach_pct", "avg_resolution_hours"),
        order="breach_count DESC NULLS LAST, department_name ASC", limit=5),
}
KPI_SQL = {name: kpi(**spec) for name, spec in KPIS.items()}
KPI1_RESOLUTION, KPI2_SLA, KPI3_SATISFACTION, KPI4_TREND, KPI5_TOP_BREACH = KPI_SQL.values()


def run_kpi(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Run one KPI statement against the stored warehouse of ``sf_dir``."""
    warehouse(spark, sf_dir).register_views()
    return run_sql(spark, KPI_SQL[name])
