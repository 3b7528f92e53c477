"""Fact builder (L4): requests -> fact_service_requests.

Natural keys are resolved to surrogate keys through the three dimensions
(inner joins, as the load does); the SLA allowance comes from ``dim_sla``
itself, so the second lookup of the SLA row is not needed.

Two forms, same rows (a test checks it):

* ``build_fact`` — requests LEFT JOIN surveys on ``request_id``, for request
  and survey tables supplied from outside. The survey side must be unique on
  ``request_id`` (``quality.key_profile``) or rows fan out; at scale this join
  is a sort-merge on ``request_id``, the one request-sized shuffle.
* ``build_fact_from_staging`` — what the load uses: requests and surveys are
  both projections of one staging row per order, so the survey columns are
  computed in place and nothing request-sized is shuffled.

In both, the dimension joins are broadcast (sizes checked), so request rows
stream through. ``fact_and_orphans`` is the second form with left joins: requests
that fail a lookup stay, marked, so that the load writes fact and quarantine in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servstar import schemas
from servstar.functions.expr import breach_minutes, presence_flag, smart_date_key


def resolve_keys(requests: DataFrame, dim_department: DataFrame,
                 dim_service_type: DataFrame, dim_sla: DataFrame, how: str = "inner") -> DataFrame:
    dd = dim_department.select("department_id", "dept_key")
    ds = dim_service_type.select("service_type_id", "service_key")
    dl = dim_sla.select("sla_id", "sla_key", F.col("sla_hours").alias("sla_hours_allowed"))
    return (requests.join(dd, "department_id", how)
                    .join(ds, "service_type_id", how)
                    .join(dl, "sla_id", how))


def _fact_row(keyed: DataFrame, has_survey: F.Column, *more: F.Column) -> DataFrame:
    """Fact columns (and ``more``) from requests with resolved keys and survey scores."""
    df = keyed.select(
        *more,
        F.col("request_id").alias("fact_id"),
        "request_id", "request_ref", "dept_key", "service_key",
        smart_date_key("submitted_at").alias("time_key"),
        "sla_key", "channel", "status", "priority", "resolution_minutes",
        "sla_hours_allowed",
        F.col("sla_compliant").alias("sla_compliant_flag"),
        breach_minutes("sla_compliant", "resolution_minutes", "sla_hours_allowed")
        .alias("sla_breach_minutes"),
        "satisfaction_score", "ease_of_use_score", "response_speed_score",
        has_survey.cast("int").alias("has_survey"),
        "submitted_at", "completed_at",
        F.current_timestamp().alias("load_timestamp"),
    )
    fact = schemas.FACT_SERVICE_REQUESTS
    if not more:
        return schemas.conform(df, fact)
    names = {f.name for f in fact.fields}
    return df.select(*[F.col(f.name).cast(f.dataType) for f in fact.fields],
                     *[c for c in df.columns if c not in names])


def build_fact(requests: DataFrame, surveys: DataFrame, dim_department: DataFrame,
               dim_service_type: DataFrame, dim_sla: DataFrame) -> DataFrame:
    """The load as written: requests, surrogate keys, LEFT JOIN surveys on
    ``request_id`` (unique there, see ``quality.key_profile``)."""
    keyed = resolve_keys(requests, dim_department, dim_service_type, dim_sla)
    sv = surveys.select("request_id", "survey_id", "satisfaction_score",
                        "ease_of_use_score", "response_speed_score")
    return _fact_row(keyed.join(sv, "request_id", "left"), presence_flag("survey_id") == 1)


def build_fact_from_staging(staging: DataFrame, dim_department: DataFrame,
                            dim_service_type: DataFrame, dim_sla: DataFrame) -> DataFrame:
    """The same rows as :func:`build_fact` when requests and surveys are both
    projections of one staging table (``binding.request_staging``): the survey
    of a request sits in the request's own staging row, so the LEFT JOIN on
    ``request_id`` reduces to computing the scores in place. This removes the
    one request-sized shuffle of the load; dimension joins stay broadcast."""
    from servstar.sources.binding import has_survey, survey_scores
    requests = staging.select("*", *survey_scores())
    keyed = resolve_keys(requests, dim_department, dim_service_type, dim_sla)
    return _fact_row(keyed, has_survey())


def fact_and_orphans(staging: DataFrame, dim_department: DataFrame, dim_service_type: DataFrame,
                     dim_sla: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Every staged request in one pass: the fact's columns, ``missing_keys`` (the lookups that
    failed, comma-joined) and ``loaded``: 1 for a fact row, 0 for one that belongs in quarantine.

    The calendar counts as a lookup too: a request without a calendar day (NULL submit date, or a
    day outside the calendar) would vanish from the monthly KPIs."""
    from servstar.sources.binding import has_survey, survey_scores
    keyed = resolve_keys(staging.select("*", *survey_scores()), dim_department, dim_service_type,
                         dim_sla, how="left")
    days = dim_time.select(F.col("time_key").alias("calendar_key"))
    keyed = keyed.join(days, smart_date_key("submitted_at") == F.col("calendar_key"), "left")
    missing = F.concat_ws(",", *[F.when(F.col(key).isNull(), F.lit(name)) for key, name in (
        ("dept_key", "department"), ("service_key", "service_type"), ("sla_key", "sla"),
        ("calendar_key", "time"))])
    return _fact_row(keyed, has_survey(), missing.alias("missing_keys"),
                     (missing == "").cast("int").alias("loaded"))
