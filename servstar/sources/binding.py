"""Bind the given TPC-H-like tables to the request / SLA / survey source shapes.

Rules (pure column expressions plus joins and aggregations; see FIXTURES.md):

* department      = nation (+ region name as sector); code ``'N' || id``
* service type    = distinct ``p_type``; id by sorted type; category Size/Line;
                    owning department = the department with most requests of it
* SLA             = one per (service type, order priority) seen in requests;
                    ``sla_id = service_type_id * 10 + priority position``;
                    hours = SLA_DAYS_BY_PRIORITY x 24
* request         = one per order; department = customer nation, channel =
                    market segment, service = type of the order's smallest part
                    key, completed = first ship day on/after the order day
                    (calendar days: the set of distinct ship days of an order
                    is bounded by the calendar, whatever its line count)
* survey          = orders with a returned ('R') line; scores from the averages
                    of discount, quantity and tax over those lines

``request_staging`` joins everything once per order; requests and surveys are
narrow projections of it.

Scale notes. ``order_lines`` is the only lineitem-sized step: one shuffle by
order key, after a map-side partial aggregate. Its per-order state is bounded
(a set of distinct ship *days*, plus sums), so an order holding a large share of
all lines still collapses map-side and cannot pin one task. Customer and part
lookups are key joins left to the planner (broadcast when small, sort-merge with
AQE skew splitting when large).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servstar import schemas
from servstar.functions.expr import (
    SIZE_TYPES, SLA_DAYS_BY_PRIORITY, add_hours, half_point, minutes_between,
    sla_hours_for_priority,
)
from servstar.operators.keys import KeyMap, keyed
from servstar.sources.tables import SourceTables


def departments(src: SourceTables) -> DataFrame:
    nation = src.table("nation", "n_nationkey", "n_name", "n_regionkey")
    region = src.table("region", "r_regionkey", "r_name")
    df = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("department_id"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("department_code"),
        F.col("n_name").alias("department_name"),
        F.col("r_name").alias("department_sector"),
    )
    return schemas.conform(df, schemas.DEPARTMENTS)


def service_catalog(src: SourceTables, keys: KeyMap | None = None) -> DataFrame:
    """service_type_id, service_code, service_name, category (one row per part type).

    Ids come from a key map over the part types: a type keeps its id, and so its SLA ids, when others appear.
    """
    types = src.table("part", "p_type").where(F.col("p_type").isNotNull()).distinct()
    return keyed(types, "service_type_id", "p_type", keys).select(
        "service_type_id",
        F.col("p_type").alias("service_code"),
        F.col("p_type").alias("service_name"),
        F.when(F.col("p_type").isin(*SIZE_TYPES), "Size").otherwise("Line").alias("category"),
    )


def order_lines(src: SourceTables) -> DataFrame:
    """Per order key: smallest part key, distinct ship days, returned-line sums."""
    li = src.table("lineitem", "l_orderkey", "l_partkey", "l_shipdate",
                              "l_returnflag", "l_quantity", "l_discount", "l_tax")
    ret = F.col("l_returnflag") == "R"
    return li.groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("first_partkey"),
        F.collect_set(F.to_date("l_shipdate")).alias("ship_days"),
        F.count_if(ret).alias("returned_lines"),
        F.sum(F.when(ret, F.round(F.col("l_discount") * 100).cast("long"))).alias("discount_pts"),
        F.sum(F.when(ret, F.col("l_quantity").cast("decimal(18,2)"))).alias("quantity_sum"),
        F.sum(F.when(ret, F.round(F.col("l_tax") * 100).cast("long"))).alias("tax_pts"),
    )


def priority_position(priority) -> F.Column:
    """1-based position of an order priority in SLA_DAYS_BY_PRIORITY (0 = unknown)."""
    return F.array_position(F.array(*[F.lit(p) for p in SLA_DAYS_BY_PRIORITY]), priority)


def request_staging(src: SourceTables, lines: DataFrame | None = None,
                    catalog: DataFrame | None = None) -> DataFrame:
    """One wide row per order: the request columns plus the returned-line
    measures the survey needs. Written once, it feeds ``service_requests`` and
    ``user_surveys`` as two narrow projections, so the order-line aggregate is
    shuffled once (into the order join) instead of once per consumer."""
    lines = order_lines(src) if lines is None else lines
    catalog = service_catalog(src) if catalog is None else catalog
    orders = src.table("orders", "o_orderkey", "o_custkey", "o_orderstatus",
                                  "o_orderdate", "o_orderpriority")
    cust = src.table("customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # the type is looked up per part, never per request
    types = catalog.select(F.col("service_code").alias("p_type"), "service_type_id")
    part = src.table("part", "p_partkey", "p_type").join(types, "p_type", "left")
    # orders without lines get a key of their own, so that they don't all meet in one
    # partition of the part join; the second condition keeps them from matching
    part_key = F.coalesce("first_partkey", -F.abs("o_orderkey") - 1)

    # completion is resolved right after the order-key join, so the ship-day
    # sets are dropped before the customer and part shuffles
    order_day = F.to_date("o_orderdate")
    completed_day = F.array_min(F.filter("ship_days", lambda d: d >= order_day))
    per_order = (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
                 .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                         "o_orderpriority", "first_partkey",
                         completed_day.cast("timestamp_ntz").alias("completed_at"),
                         "returned_lines", "discount_pts", "quantity_sum", "tax_pts"))
    df = (per_order
          .join(cust, per_order.o_custkey == cust.c_custkey, "left")
          .join(part, (part_key == part.p_partkey) & F.col("first_partkey").isNotNull(), "left"))

    pos = priority_position(F.col("o_orderpriority"))
    sla_id = F.when(F.col("service_type_id").isNotNull() & (pos > 0),
                    F.col("service_type_id") * 10 + pos)
    sla_hours = sla_hours_for_priority(F.col("o_orderpriority"))

    df = df.select(
        F.col("o_orderkey").alias("request_id"),
        F.concat(F.lit("REQ-"), F.col("o_orderkey").cast("string")).alias("request_ref"),
        F.col("c_nationkey").alias("department_id"),
        "service_type_id",
        sla_id.alias("sla_id"),
        F.col("c_name").alias("requester_name"),
        F.col("c_mktsegment").alias("channel"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("submitted_at"),
        "completed_at",
        sla_hours.alias("_sla_hours"),
        F.coalesce("returned_lines", F.lit(0)).alias("returned_lines"),
        "discount_pts", "quantity_sum", "tax_pts",
    )
    resolution = minutes_between("submitted_at", "completed_at")
    return (df.withColumn("resolution_minutes", resolution)
              .withColumn("sla_deadline", add_hours("submitted_at", "_sla_hours"))
              .withColumn("sla_compliant",
                          F.when(F.col("completed_at").isNotNull()
                                 & (F.col("resolution_minutes") <= F.col("_sla_hours") * 60), 1)
                           .otherwise(0)))


def requests_from_staging(staging: DataFrame) -> DataFrame:
    return schemas.conform(staging, schemas.SERVICE_REQUESTS)


def has_survey() -> F.Column:
    """A request is surveyed when it has at least one returned line."""
    return F.coalesce(F.col("returned_lines"), F.lit(0)) > 0


def survey_scores() -> list[F.Column]:
    """Scores from the returned-line measures: half points of
    1 + 4d/10, 1 + q/12.5 and 1 + t/2 (d, t in points, averaged per line);
    NULL when the request has no returned line."""
    n = F.col("returned_lines").cast("double")
    d = F.col("discount_pts") / n
    q = F.col("quantity_sum").cast("double") / n
    t = F.col("tax_pts") / n
    raw = {"satisfaction_score": F.lit(1.0) + F.lit(4.0) * d / F.lit(10.0),
           "ease_of_use_score": F.lit(1.0) + q / F.lit(12.5),
           "response_speed_score": F.lit(1.0) + t / F.lit(2.0)}
    return [F.when(has_survey(), half_point(v)).cast(schemas.SCORE).alias(k)
            for k, v in raw.items()]


def surveys_from_measures(df: DataFrame, key: str) -> DataFrame:
    """Surveys for rows with at least one returned line."""
    out = df.where(has_survey()).select(
        F.col(key).alias("survey_id"), F.col(key).alias("request_id"), *survey_scores())
    return schemas.conform(out, schemas.USER_SURVEYS)


def surveys_from_staging(staging: DataFrame) -> DataFrame:
    return surveys_from_measures(staging, "request_id")


def service_requests(src: SourceTables, lines: DataFrame | None = None,
                     catalog: DataFrame | None = None) -> DataFrame:
    return requests_from_staging(request_staging(src, lines, catalog))


def user_surveys(src: SourceTables, lines: DataFrame | None = None) -> DataFrame:
    """Surveys straight off ``order_lines`` (already partitioned by order key),
    restricted to orders that exist (a survey's request must exist)."""
    lines = order_lines(src) if lines is None else lines
    orders = src.table("orders", "o_orderkey")
    lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left_semi")
    return surveys_from_measures(lines, "l_orderkey")


def service_types(catalog: DataFrame, requests: DataFrame) -> DataFrame:
    """Catalog plus owning department: the one with most requests of the type
    (ties to the smallest id). Partial aggregation keeps the shuffle at
    (type x department) cells."""
    cells = (requests.where(F.col("service_type_id").isNotNull()
                            & F.col("department_id").isNotNull())
             .groupBy("service_type_id", "department_id").agg(F.count("*").alias("n")))
    owner = cells.groupBy("service_type_id").agg(
        F.max_by("department_id", F.struct(F.col("n"), -F.col("department_id")))
         .alias("department_id"))
    return schemas.conform(catalog.join(owner, "service_type_id", "left"),
                           schemas.SERVICE_TYPES)


def sla_definitions(requests: DataFrame) -> DataFrame:
    """One SLA per (service type, priority) that occurs in the requests."""
    df = (requests.where(F.col("sla_id").isNotNull())
          .groupBy("sla_id", "service_type_id", "priority").agg(F.count("*").alias("n"))
          .select("sla_id", "service_type_id",
                  F.col("priority").alias("priority_level"),
                  sla_hours_for_priority(F.col("priority")).alias("sla_hours")))
    return schemas.conform(df, schemas.SLA_DEFINITIONS)


def sla_lookup_latest(sla: DataFrame) -> DataFrame:
    """Service -> (sla_id, sla_hours); when a service has several SLA rows the
    last one (highest sla_id) wins, as a dict built row by row would keep."""
    return sla.groupBy("service_type_id").agg(
        F.max_by(F.struct("sla_id", "sla_hours"), F.col("sla_id")).alias("latest")
    ).select("service_type_id", "latest.sla_id", "latest.sla_hours")


def calendar_bounds(src: SourceTables) -> DataFrame:
    """First and last day of the calendar: whole years spanning the orders."""
    o = src.table("orders", "o_orderdate")
    return o.agg(F.make_date(F.year(F.min("o_orderdate")), F.lit(1), F.lit(1)).alias("start"),
                 F.make_date(F.year(F.max("o_orderdate")), F.lit(12), F.lit(31)).alias("end"))
