"""Query registry: name -> (spark, sf_dir) -> DataFrame, and name -> DuckDB SQL.

(``effective_date``, ``load_timestamp``) are left out of compared columns.
The DuckDB statements read only the given tables; the star schema is
re-derived there by ``servstar.oracle``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from servstar import schemas
from servstar.functions.expr import (
    half_point_even, lower_names, sla_category, strip_prefix,
)
from servstar.operators import constraints, fact, quality
from servstar.operators.keys import KeyMap
from servstar.oracle import (
    EVENT_PRIORITY, FRAME_ORACLE, KEY_COLUMNS, KPI_ORACLE, MART_ORACLE, REFERENCES, REQUIRED_COLUMNS, with_star,
)
from servstar.plans import flow, incremental, kpis_frame, kpis_sql, marts, sinks, summary
from servstar.plans.warehouse import SOURCE_TABLES, STAR_TABLES, warehouse
from servstar.sources import binding, bucketed
from servstar.sources.tables import SourceTables, resolve_codes
from servstar.session import scratch_path
from servstar.streaming import events as ev

QUERIES = {}
ORACLE_SQL = {}


def _register(name, fn, oracle: str | None):
    QUERIES[name] = fn
    if oracle is not None:
        ORACLE_SQL[name] = oracle


def _cols(table: str, drop=("effective_date", "load_timestamp", "created_at",
                              "surveyed_at")) -> list[str]:
    return [f.name for f in schemas.TABLES[table].fields if f.name not in drop]


# -- step 1/4: KPI SQL (Q1-Q5) -------------------------------------------------------------
for _name in kpis_sql.KPI_SQL:
    _register(_name, (lambda n: lambda spark, sf_dir: kpis_sql.run_kpi(spark, sf_dir, n))(_name),
              KPI_ORACLE[_name])


# -- step 2/3: source tables, dimensions, fact -----------------------------------------------
def _stored(table: str):
    cols = _cols(table)
    return lambda spark, sf_dir: warehouse(spark, sf_dir).table(table).select(*cols)


for _t in SOURCE_TABLES + STAR_TABLES:
    _register(_t, _stored(_t), with_star(f"SELECT {', '.join(_cols(_t))} FROM {_t}"))


_register("sla_lookup_latest",
          lambda spark, sf_dir: binding.sla_lookup_latest(
              warehouse(spark, sf_dir).sla_definitions),
          with_star("""
SELECT service_type_id, sla_id, sla_hours FROM (
    SELECT service_type_id, sla_id, sla_hours,
           row_number() OVER (PARTITION BY service_type_id ORDER BY sla_id DESC) AS rk
    FROM sla_definitions) x
WHERE rk = 1"""))

_register("fact_sla_deadline",
          lambda spark, sf_dir: warehouse(spark, sf_dir).service_requests.select(
              "request_id", "submitted_at", "completed_at", "resolution_minutes",
              "sla_deadline", "sla_compliant"),
          with_star("""
SELECT request_id, submitted_at, completed_at, resolution_minutes, sla_deadline, sla_compliant
FROM service_requests"""))

_register("fact_breach_minutes",
          lambda spark, sf_dir: warehouse(spark, sf_dir).fact_service_requests.select(
              "fact_id", "sla_compliant_flag", "resolution_minutes", "sla_hours_allowed",
              "sla_breach_minutes"),
          with_star("""
SELECT fact_id, sla_compliant_flag, resolution_minutes, sla_hours_allowed, sla_breach_minutes
FROM fact_service_requests"""))


# -- step 5: frame KPIs (T1-T4, O6) -----------------------------------------------------------
for _name in ("kpi1_resolution_frame", "kpi1_preview", "kpi2_sla_frame", "kpi3_satisfaction_frame", "kpi4_trend_frame"):
    _register(_name, getattr(kpis_frame, _name), FRAME_ORACLE[_name])


# -- step 6: dashboard datasets, snapshot, row counts (C1-C5, V1, IO12) -------------------------
_register("mart_requests_per_dept", marts.mart_requests_per_dept, MART_ORACLE["mart_requests_per_dept"])
_register("mart_sla_trend", marts.mart_sla_trend, MART_ORACLE["mart_sla_trend"])
_register("mart_satisfaction_vs_sla", marts.mart_satisfaction_vs_sla, MART_ORACLE["mart_satisfaction_vs_sla"])
_register("mart_resolution_vs_sla", marts.mart_resolution_vs_sla, MART_ORACLE["mart_resolution_vs_sla"])
_register("mart_kpi_tiles", marts.mart_kpi_tiles, MART_ORACLE["mart_kpi_tiles"])
_register("load_snapshot", marts.load_snapshot_q, MART_ORACLE["load_snapshot"])
_register("load_row_counts", marts.load_row_counts, with_star("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
    for t in SOURCE_TABLES + STAR_TABLES)))


# -- step 7: data quality (DQ1-DQ6) -----------------------------------------------------------
def _dq_tables(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return {t: wh.table(t) for t in SOURCE_TABLES + STAR_TABLES}


def _key_profile_sql(table: str, *key: str) -> str:
    k = ", ".join(key)
    null_key = " OR ".join(f"{c} IS NULL" for c in key)
    return f"""
SELECT '{table}' AS table_name, '{",".join(key)}' AS key_columns,
       CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_rows,
       CAST(COUNT(*) AS BIGINT) AS distinct_keys,
       CAST(COALESCE(SUM(CASE WHEN is_null = 1 THEN n ELSE 0 END), 0) AS BIGINT) AS null_key_rows,
       CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicated_keys,
       CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n ELSE 0 END), 0) AS BIGINT) AS duplicated_rows
FROM (SELECT {k}, COUNT(*) AS n, MAX(CASE WHEN {null_key} THEN 1 ELSE 0 END) AS is_null
      FROM {table} GROUP BY {k}) g"""


_register("dq_duplicate_keys",
          lambda spark, sf_dir: quality.duplicate_keys(_dq_tables(spark, sf_dir)),
          with_star("\nUNION ALL\n".join(
              _key_profile_sql(t, key) for t, keys in KEY_COLUMNS.items() for key in keys)))

_register("dq_null_counts",
          lambda spark, sf_dir: quality.all_null_counts(_dq_tables(spark, sf_dir)),
          with_star("\nUNION ALL\n".join(
              f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
              f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM {t}"
              for t, required in REQUIRED_COLUMNS.items() for c in required.split())))

_register("dq_orphans",
          lambda spark, sf_dir: quality.orphan_report(_dq_tables(spark, sf_dir)),
          with_star("\nUNION ALL\n".join(f"""
SELECT '{c}' AS child_table, '{col}' AS child_column, '{p}' AS parent_table,
       CAST(COUNT(*) AS BIGINT) AS checked_rows,
       CAST(COUNT(*) FILTER (WHERE x.{col} IS NULL) AS BIGINT) AS null_rows,
       CAST(COUNT(*) FILTER (WHERE x.{col} IS NOT NULL AND k.pk IS NULL) AS BIGINT) AS orphan_rows
FROM {c} x LEFT JOIN (SELECT DISTINCT {col} AS pk FROM {p}) k ON x.{col} = k.pk"""
              for c, p, col in REFERENCES)))

_register("fact_quarantine",
          lambda spark, sf_dir: warehouse(spark, sf_dir).table("_quarantine/fact_orphans"),
          with_star("""
SELECT r.request_id, r.request_ref,
       concat_ws(',', CASE WHEN dd.dept_key IS NULL THEN 'department' END,
                      CASE WHEN ds.service_key IS NULL THEN 'service_type' END,
                      CASE WHEN dl.sla_key IS NULL THEN 'sla' END,
                      CASE WHEN t.time_key IS NULL THEN 'time' END) AS missing_keys
FROM service_requests r
LEFT JOIN dim_department dd   ON r.department_id = dd.department_id
LEFT JOIN dim_service_type ds ON r.service_type_id = ds.service_type_id
LEFT JOIN dim_sla dl          ON r.sla_id = dl.sla_id
LEFT JOIN dim_time t          ON t.full_date = CAST(r.submitted_at AS DATE)
WHERE dd.dept_key IS NULL OR ds.service_key IS NULL OR dl.sla_key IS NULL OR t.time_key IS NULL"""))

_register("dq_score_range",
          lambda spark, sf_dir: quality.score_range(warehouse(spark, sf_dir).user_surveys),
          with_star("\nUNION ALL\n".join(
              f"SELECT '{c}' AS column_name, CAST(COUNT({c}) AS BIGINT) AS checked, "
              f"CAST(COUNT(*) FILTER (WHERE NOT ({c} BETWEEN 1 AND 5)) AS BIGINT) AS out_of_range "
              f"FROM user_surveys" for c in quality.SCORE_COLUMNS)))


# -- checks on given tables that do violate them, and branches the bound tables never reach ----
def _given(table: str, *columns: str):
    return lambda spark, sf_dir: SourceTables(spark, sf_dir).table(table, *columns)


_lines, _orders = _given("lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount"), _given("orders", "o_orderkey")
_register("dq_line_duplicates",
          lambda spark, sf_dir: quality.duplicate_rows(_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"]), """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""")
_register("dq_line_key_profile",
          lambda spark, sf_dir: quality.key_profile(_lines(spark, sf_dir), "lineitem", ["l_orderkey", "l_linenumber"]),
          _key_profile_sql("lineitem", "l_orderkey", "l_linenumber"))
_register("dq_orders_without_lines",
          lambda spark, sf_dir: quality.orphans(_orders(spark, sf_dir), "o_orderkey", _lines(spark, sf_dir), "l_orderkey"), """
SELECT o_orderkey FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey""")
_register("dq_line_ranges",
          lambda spark, sf_dir: quality.score_range(_lines(spark, sf_dir), 2.0, 40.0, ("l_quantity", "l_discount")), """
SELECT 'l_quantity' AS column_name, COUNT(l_quantity) AS checked,
       COUNT(*) FILTER (l_quantity < 2 OR l_quantity > 40) AS out_of_range FROM lineitem
UNION ALL
SELECT 'l_discount', COUNT(l_discount), COUNT(*) FILTER (l_discount < 2 OR l_discount > 40) FROM lineitem""")
_register("dq_lines_out_of_range",
          lambda spark, sf_dir: quality.out_of_range_rows(
              _lines(spark, sf_dir), 2.0, 40.0, ("l_quantity",)).select("l_orderkey", "l_linenumber", "l_quantity"), """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 2 OR l_quantity > 40""")
_register("json_path_missing",
          lambda spark, sf_dir: flow.validate_json(
              SourceTables(spark, sf_dir).table("events"), ("k", "channel"), "props"), """
SELECT json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS channel, 'channel' AS missing_fields, 0 AS valid
FROM events""")
_register("sla_category_bands",
          lambda spark, sf_dir: _orders(spark, sf_dir).select(
              "o_orderkey", (F.col("o_orderkey") % 200).cast("int").alias("hours"),
              sla_category(F.col("o_orderkey") % 200).alias("category")), """
SELECT o_orderkey, CAST(o_orderkey % 200 AS INTEGER) AS hours,
       CASE WHEN o_orderkey % 200 <= 24 THEN 'Same Day' WHEN o_orderkey % 200 <= 72 THEN 'Standard'
            WHEN o_orderkey % 200 <= 168 THEN 'Extended' ELSE 'Long Term' END AS category
FROM orders""")
_register("nation_labels",
          lambda spark, sf_dir: SourceTables(spark, sf_dir).table("nation").select(
              "n_nationkey", strip_prefix("n_name", "NATION_").alias("label")), """
SELECT n_nationkey, substr(n_name, 8) AS label FROM nation""")


def _fact_by_survey_join(spark, sf_dir):
    """The load as written: requests LEFT JOIN surveys (the stored fact computes the scores in place)."""
    wh = warehouse(spark, sf_dir)
    return fact.build_fact(wh.service_requests, wh.user_surveys, wh.dim("dim_department"), wh.dim("dim_service_type"),
                           wh.dim("dim_sla")).select(*_cols("fact_service_requests"))


_register("fact_survey_join", _fact_by_survey_join, ORACLE_SQL["fact_service_requests"])
_register("fact_survey_join_bucketed",
          lambda spark, sf_dir: bucketed.fact_by_survey_join(spark, sf_dir).select(*_cols("fact_service_requests")),
          ORACLE_SQL["fact_service_requests"])
_register("dq_request_keys_bucketed", bucketed.key_profiles, with_star("\nUNION ALL\n".join(
    _key_profile_sql(t, "request_id") for t in ("service_requests", "user_surveys"))))
_register("dq_requests_surveyed", bucketed.requests_surveyed, with_star("""
SELECT COUNT(*) FILTER (s.survey_id IS NOT NULL AND r.request_ref IS NOT NULL) AS surveyed,
       COUNT(*) FILTER (s.survey_id IS NULL) AS not_surveyed, COUNT(*) FILTER (r.request_ref IS NULL) AS surveys_without_request
FROM service_requests r FULL JOIN user_surveys s ON s.request_id = r.request_id"""))


_LINE_RULES = [
    constraints.Unique(("l_orderkey", "l_linenumber")), constraints.Between("l_quantity", 2, 40), constraints.OneOf("l_returnflag", ("A", "N")),
    constraints.References("l_suppkey", "suppliers", "s_suppkey"), constraints.References("l_orderkey", "orders", "o_orderkey")]


def _line_violations(spark, sf_dir):
    """Lines by the list of constraints they violate; the suppliers are those with a positive balance."""
    src = SourceTables(spark, sf_dir)
    parents = {"suppliers": src.table("supplier").filter("s_acctbal > 0"), "orders": src.table("orders")}
    lines = src.table("lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_suppkey")
    accepted, bad = constraints.load_checked(lines, _LINE_RULES, scratch_path(spark, "checked-lines"), parents)
    listed = bad.groupBy(F.array_join("violations", ", ").alias("violations")).agg(F.count(F.lit(1)).alias("lines"))
    return listed.unionByName(accepted.agg(F.count(F.lit(1)).alias("lines")).select(F.lit("").alias("violations"), "lines"))


_register("dq_line_constraints", _line_violations, """
SELECT violations, COUNT(*) AS lines FROM (
    SELECT concat_ws(', ', CASE WHEN n > 1 THEN 'l_orderkey,l_linenumber repeated' END,
                     CASE WHEN l_quantity < 2 OR l_quantity > 40 THEN 'l_quantity out of range' END,
                     CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'l_returnflag not listed' END,
                     CASE WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) THEN 'l_suppkey not in suppliers' END,
                     CASE WHEN l_orderkey NOT IN (SELECT o_orderkey FROM orders) THEN 'l_orderkey not in orders' END) AS violations
    FROM (SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) x) y
GROUP BY violations""")


def _checked_sources(spark, sf_dir):
    """Rows that the declared constraints accept and quarantine, per source table. Suppose nations above 20 were no departments."""
    wh = warehouse(spark, sf_dir)
    tables = {t: wh.table(t) for t in SOURCE_TABLES} | {"departments": wh.table("departments").filter("department_id <= 20")}
    out = None
    for t, df in tables.items():
        accepted, bad = constraints.load_checked(df, constraints.declared(t), scratch_path(spark, f"checked-{t}"), tables)
        row = accepted.agg(F.count(F.lit(1)).alias("accepted")).crossJoin(bad.agg(F.count(F.lit(1)).alias("quarantined"))) \
            .select(F.lit(t).alias("table_name"), "accepted", "quarantined")
        out = row if out is None else out.unionByName(row)
    return out


_register("dq_source_quarantine", _checked_sources, with_star("""
SELECT 'departments' AS table_name, COUNT(*) FILTER (department_id <= 20) AS accepted, CAST(0 AS BIGINT) AS quarantined FROM departments
UNION ALL SELECT 'service_types', COUNT(*) FILTER (department_id IS NULL OR department_id <= 20), COUNT(*) FILTER (department_id > 20) FROM service_types
UNION ALL SELECT 'sla_definitions', COUNT(*), 0 FROM sla_definitions
UNION ALL SELECT 'service_requests', COUNT(*) FILTER (department_id <= 20 AND service_type_id IS NOT NULL),
                 COUNT(*) FILTER (department_id IS NULL OR department_id > 20 OR service_type_id IS NULL) FROM service_requests
UNION ALL SELECT 'user_surveys', COUNT(*), 0 FROM user_surveys"""))


# -- keys that last, and small rules on given rows (F26, F3, F24, F25, PF14, J9) ------------------
def _keys_reload(spark, sf_dir):
    """Keys of the part types after a load without every third brand's parts and one with all."""
    part = SourceTables(spark, sf_dir).table("part", "p_type", "p_brand")
    keys = KeyMap(spark, scratch_path(spark, "part-type-keys"), "type_key", "p_type")
    keys.extend(part.filter("p_type not like 'E%' and p_type not like 'M%'"))
    return keys.keyed(part.select("p_type").distinct())


_register("keys_after_reload", _keys_reload, """
WITH t AS (SELECT DISTINCT p_type, p_type LIKE 'E%' OR p_type LIKE 'M%' AS late FROM part)
SELECT p_type, row_number() OVER (ORDER BY late, p_type) AS type_key FROM t""")
_register("half_points_even",
          lambda spark, sf_dir: SourceTables(spark, sf_dir).table("lineitem", "l_orderkey", "l_linenumber", "l_quantity").select(
              "l_orderkey", "l_linenumber", half_point_even(F.col("l_quantity") / 4).alias("half_points")), """
SELECT l_orderkey, l_linenumber, round_even(l_quantity / 4 * 2, 0) / 2 AS half_points FROM lineitem""")
_register("column_defaults",
          lambda spark, sf_dir: schemas.conform(
              lower_names(SourceTables(spark, sf_dir).table("orders", "o_orderkey").toDF("REQUEST_ID")),
              schemas.SERVICE_REQUESTS).select(
              "request_id", "status", "priority", "sla_compliant", F.col("created_at").isNotNull().cast("int").alias("stamped")), """
SELECT o_orderkey AS request_id, 'SUBMITTED' AS status, 'NORMAL' AS priority, 0 AS sla_compliant, 1 AS stamped FROM orders""")
_register("code_lookup",
          lambda spark, sf_dir: resolve_codes(
              SourceTables(spark, sf_dir).table("part", "p_partkey", "p_type"),
              warehouse(spark, sf_dir).service_types.filter("service_type_id % 2 = 1"), "p_type", "service_code", "service_type_id"), with_star("""
SELECT p_partkey, CASE WHEN service_type_id % 2 = 1 THEN service_type_id END AS service_type_id
FROM part LEFT JOIN service_types ON service_code = p_type"""))


# -- step 8: sinks and the load-once guard (IO5-IO7) -------------------------------------------
_register("csv_roundtrip", sinks.csv_roundtrip, KPI_ORACLE["kpi1_resolution_sql"])
_register("load_if_empty_twice", sinks.load_if_empty_twice, with_star("""
SELECT 1 AS attempt, 1 AS loaded, COUNT(*) AS row_count FROM fact_service_requests
UNION ALL
SELECT 2 AS attempt, 0 AS loaded, COUNT(*) AS row_count FROM fact_service_requests"""))


# -- step 9: streaming (ST1-ST8, IO10, IO11, F27-F29) --------------------------------------------
def faulty(messages):
    """What a faulty producer sends: texts of 'error' events cut short, 'signup' events without a priority."""
    department = F.get_json_object("value", "$.department")
    return messages.withColumn("value", F.when(department == "error", F.substring("value", 1, 40)).when(
        department == "signup", F.regexp_replace("value", ',"priority":"[^"]*"', "")).otherwise(F.col("value")))


def _stream_quarantine(spark, sf_dir):
    """Unreadable messages of a faulty producer: event id, and whether the text is whole."""
    bad = ev.stream_run(spark, sf_dir, faulty).table("quarantine", spark)
    return bad.select(F.regexp_extract("raw", r'"event_id":"(\d+)"', 1).cast("long").alias("event_id"),
                      F.endswith("raw", F.lit("}")).cast("int").alias("whole"))


_register("stream_by_department", ev.stream_by_department, """
SELECT event_type AS department, COUNT(*) AS events FROM events GROUP BY event_type""")
_register("stream_by_priority", ev.stream_by_priority, f"""
SELECT {EVENT_PRIORITY} AS priority, COUNT(*) AS events FROM events GROUP BY 1""")
_register("stream_state_counts", ev.stream_state_counts, f"""
SELECT event_type AS department, {EVENT_PRIORITY} AS priority, COUNT(*) AS events FROM events GROUP BY 1, 2""")
_register("stream_total", ev.stream_total, "SELECT COUNT(*) AS total_events FROM events")
_register("stream_quarantine", _stream_quarantine, """
SELECT event_id, CAST(event_type = 'signup' AS INTEGER) AS whole FROM events WHERE event_type IN ('signup', 'error')""")
_register("stream_projection", ev.stream_projection, f"""
SELECT 'EVT-' || CAST(event_id AS VARCHAR) AS request_ref, event_type AS department,
       'SVC-' || CAST(user_id AS VARCHAR) AS service_type, {EVENT_PRIORITY} AS priority,
       ts AS event_time
FROM events""")
_register("json_roundtrip", ev.json_roundtrip, f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, '{ev.EVENT_TYPE}' AS event_type,
       'EVT-' || CAST(event_id AS VARCHAR) AS request_ref, event_type AS department,
       'SVC-' || CAST(user_id AS VARCHAR) AS service_type, 'events' AS channel,
       {EVENT_PRIORITY} AS priority, 'user_' || CAST(user_id AS VARCHAR) AS requester_name,
       CAST(NULL AS VARCHAR) AS requester_email, '{ev.EVENT_STATUS}' AS status,
       ts AS event_time, 1 AS decoded_ok
FROM events""")


# -- step 10: declared flow (N1-N5) -------------------------------------------------------------
_register("incremental_extract", flow.incremental_extract, """
SELECT 1 AS run, COUNT(*) AS extracted_rows, MAX(o_orderkey) AS max_key,
       COUNT(*) AS target_rows FROM orders
UNION ALL
SELECT 2 AS run, 0 AS extracted_rows, MAX(o_orderkey) AS max_key,
       COUNT(*) AS target_rows FROM orders""")
_register("json_path_validate", flow.json_path_validate, f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, 'EVT-' || CAST(event_id AS VARCHAR) AS request_ref,
       event_type AS department, {EVENT_PRIORITY} AS priority,
       CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp,
       '' AS missing_fields, 1 AS valid
FROM events""")
_register("sla_flag", flow.sla_flag_q, with_star("""
SELECT request_id, submitted_at, sla_deadline, completed_at,
       CASE WHEN completed_at IS NOT NULL AND completed_at <= sla_deadline THEN 1 ELSE 0 END
           AS sla_flag,
       sla_compliant
FROM service_requests"""))
_register("conform_schema", flow.conform_schema, f"""
SELECT 'EVT-' || CAST(event_id AS VARCHAR) AS request_ref, event_type AS department_code,
       'SVC-' || CAST(user_id AS VARCHAR) AS service_name, 'events' AS channel,
       {EVENT_PRIORITY} AS priority, '{ev.EVENT_STATUS}' AS status,
       'user_' || CAST(user_id AS VARCHAR) AS requester_name,
       CAST(NULL AS VARCHAR) AS requester_email, ts AS submitted_at
FROM events""")
_register("json_variant_fields", flow.json_variant_fields, """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE event_type WHEN 'error' THEN 'unreadable' WHEN 'view' THEN 'missing' WHEN 'click' THEN 'missing'
                       WHEN 'signup' THEN 'wrong type' ELSE 'ok' END AS k_state
FROM events""")

#: A full reload of the second day, and the three runs' counts from plain comparisons of the two days.
_REQUEST_ROWS = """
SELECT request_id, request_ref, department_id, channel, status, priority, submitted_at, sla_deadline, completed_at,
       CASE WHEN completed_at IS NOT NULL AND completed_at <= sla_deadline THEN 1 ELSE 0 END AS sla_flag
FROM service_requests WHERE request_id % 17 <> 0"""
_register("incremental_load_rows", incremental.incremental_load_rows, with_star(_REQUEST_ROWS))
_register("incremental_load", incremental.incremental_load, with_star("""
SELECT 1 AS run, a.n + g.n AS new_rows, 0 AS changed_rows, 0 AS removed_rows, a.bad + g.bad AS rejected_rows,
       am.n AS months_written, a.n + g.n AS target_rows
FROM (SELECT COUNT(*) FILTER (request_id % 17 <> 0) AS n, COUNT(*) FILTER (request_id % 17 = 0) AS bad FROM service_requests WHERE request_id % 7 <> 0) a,
     (SELECT COUNT(*) FILTER (request_id % 17 <> 0) AS n, COUNT(*) FILTER (request_id % 17 = 0) AS bad FROM service_requests WHERE request_id % 13 = 0) g,
     (SELECT COUNT(DISTINCT strftime(submitted_at, '%Y-%m')) AS n FROM service_requests
      WHERE request_id % 17 <> 0 AND (request_id % 7 <> 0 OR request_id % 13 = 0)) am
UNION ALL
SELECT 2, COUNT(*) FILTER (request_id % 7 = 0), COUNT(*) FILTER (request_id % 7 <> 0 AND request_id % 11 = 0 AND channel IS DISTINCT FROM 'OLD'),
       COUNT(*) FILTER (request_id % 13 = 0), (SELECT COUNT(*) FROM service_requests WHERE request_id % 17 = 0),
       COUNT(DISTINCT CASE WHEN request_id % 7 = 0 OR request_id % 11 = 0 OR request_id % 13 = 0 THEN strftime(submitted_at, '%Y-%m') END),
       COUNT(*)
FROM service_requests WHERE request_id % 17 <> 0
UNION ALL
SELECT 3, 0, 0, 0, COUNT(*) FILTER (request_id % 17 = 0), 0, COUNT(*) FILTER (request_id % 17 <> 0) FROM service_requests"""))


# -- the same over a summary kept up by month (Q1-Q5, T1-T4, C1-C5, V1), and pruning by month (IO9, J2) -------
for _name in summary.KPI_SQL:
    _register(f"{_name}_summary", (lambda n: lambda spark, sf_dir: summary.run_kpi(spark, sf_dir, n))(_name), KPI_ORACLE[_name])
for _name in summary.FRAMES:
    _register(f"{_name}_summary", (lambda n: lambda spark, sf_dir: summary.run_frame(spark, sf_dir, n))(_name), ORACLE_SQL[_name])
_register("kpi2_of_year", lambda spark, sf_dir: summary.kpi2_of_year(spark, sf_dir, 1995),
          f"SELECT * FROM ({KPI_ORACLE['kpi2_sla_sql']}) k WHERE year_num = 1995")
_register("summary_cells", summary.summary_cells, with_star("""
SELECT CAST(time_key // 100 AS INTEGER) AS month, dept_key, service_key, time_key, has_survey,
       CAST(resolution_minutes IS NOT NULL AS INTEGER) AS timed, COUNT(*) AS requests,
       COUNT(*) FILTER (has_survey = 1) AS surveys, COUNT(sla_compliant_flag) AS judged,
       CAST(SUM(sla_compliant_flag) AS BIGINT) AS met, COUNT(*) FILTER (sla_compliant_flag = 0) AS missed,
       CAST(SUM(resolution_minutes) AS DOUBLE) AS minutes_sum, CAST(MIN(resolution_minutes) AS DOUBLE) AS minutes_min,
       CAST(MAX(resolution_minutes) AS DOUBLE) AS minutes_max, CAST(SUM(satisfaction_score) AS DOUBLE) AS satisfaction_sum
FROM fact_service_requests JOIN dim_time USING (time_key) GROUP BY 1, 2, 3, 4, 5, 6"""))
_register("summary_maintained", summary.summary_maintained, with_star("""
SELECT 1 AS run, COUNT(*) FILTER (NOT later) AS new_rows, 0 AS changed_rows, 0 AS removed_rows,
       COUNT(DISTINCT CASE WHEN NOT later THEN m END) AS months_written, COUNT(DISTINCT CASE WHEN NOT later THEN m END) AS months_summed
FROM (SELECT *, time_key // 100 AS m, fact_id % 7 = 0 AND time_key // 100 % 100 <= 6 AS later FROM fact_service_requests) f
UNION ALL
SELECT 2, COUNT(*) FILTER (later), COUNT(*) FILTER (changed), 0,
       COUNT(DISTINCT CASE WHEN later OR changed THEN m END), COUNT(DISTINCT CASE WHEN later OR changed THEN m END)
FROM (SELECT *, NOT later AND fact_id % 11 = 0 AND m % 100 <= 3 AND has_survey = 1 AS changed FROM (
      SELECT *, time_key // 100 AS m, fact_id % 7 = 0 AND time_key // 100 % 100 <= 6 AS later FROM fact_service_requests) f) g
UNION ALL SELECT 3, 0, 0, 0, 0, 0"""))
