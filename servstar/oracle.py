"""DuckDB SQL that re-derives the source tables and the star schema from the
given tables, written independently of the Spark code (plain joins and
GROUP BYs, no array tricks). ``with_star(sql)`` prefixes any statement that
reads the star / source names with these definitions.
"""

from __future__ import annotations

STAR_CTES = """
sla_levels(priority, pos, days) AS (VALUES ('1-URGENT', 1, 90), ('2-HIGH', 2, 180), ('3-MEDIUM', 3, 365),
                                           ('4-NOT SPECIFIED', 4, 540), ('5-LOW', 5, 730)),
departments AS (
    SELECT CAST(n.n_nationkey AS BIGINT)            AS department_id,
           'N' || CAST(n.n_nationkey AS VARCHAR)    AS department_code,
           n.n_name                                 AS department_name,
           r.r_name                                 AS department_sector,
           CAST(NULL AS TIMESTAMP)                  AS created_at
    FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
service_catalog AS (
    SELECT CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS service_type_id,
           p_type AS service_code,
           p_type AS service_name,
           CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'Size' ELSE 'Line' END AS category
    FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL) x
),
order_first_part AS (
    SELECT l_orderkey, min(l_partkey) AS first_partkey FROM lineitem GROUP BY l_orderkey
),
order_completion AS (
    SELECT o.o_orderkey, CAST(min(CAST(l.l_shipdate AS DATE)) AS TIMESTAMP) AS completed_at
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    WHERE CAST(l.l_shipdate AS DATE) >= CAST(o.o_orderdate AS DATE)
    GROUP BY o.o_orderkey
),
requests_base AS (
    SELECT o.o_orderkey                              AS request_id,
           'REQ-' || CAST(o.o_orderkey AS VARCHAR)   AS request_ref,
           CAST(c.c_nationkey AS BIGINT)             AS department_id,
           sc.service_type_id,
           CASE WHEN sc.service_type_id IS NOT NULL AND lv.pos IS NOT NULL
                THEN sc.service_type_id * 10 + lv.pos END AS sla_id,
           c.c_name                                  AS requester_name,
           c.c_mktsegment                            AS channel,
           o.o_orderstatus                           AS status,
           o.o_orderpriority                         AS priority,
           o.o_orderdate                             AS submitted_at,
           oc.completed_at,
           CAST(lv.days * 24 AS DECIMAL(9,2))        AS sla_hours
    FROM orders o
    LEFT JOIN customer c          ON o.o_custkey = c.c_custkey
    LEFT JOIN order_first_part fp ON fp.l_orderkey = o.o_orderkey
    LEFT JOIN part p              ON p.p_partkey = fp.first_partkey
    LEFT JOIN service_catalog sc  ON sc.service_code = p.p_type
    LEFT JOIN order_completion oc ON oc.o_orderkey = o.o_orderkey
    LEFT JOIN sla_levels lv       ON lv.priority = o.o_orderpriority
),
service_requests AS (
    SELECT request_id, request_ref, department_id, service_type_id, sla_id,
           requester_name, CAST(NULL AS VARCHAR) AS requester_email, channel, status,
           priority, submitted_at, CAST(NULL AS TIMESTAMP) AS assigned_at, completed_at,
           CAST(CAST(date_diff('second', submitted_at, completed_at) AS DECIMAL(20,2)) / 60
                AS DECIMAL(10,2)) AS resolution_minutes,
           submitted_at + to_seconds(CAST(sla_hours * 3600 AS BIGINT)) AS sla_deadline,
           CASE WHEN completed_at IS NOT NULL
                 AND date_diff('second', submitted_at, completed_at) <= sla_hours * 3600
                THEN 1 ELSE 0 END AS sla_compliant,
           CAST(NULL AS VARCHAR) AS notes, CAST(NULL AS TIMESTAMP) AS created_at
    FROM requests_base
),
returned AS (
    SELECT l_orderkey,
           count(*) AS n,
           sum(CAST(round(l_discount * 100) AS BIGINT)) AS discount_pts,
           sum(l_quantity) AS quantity_sum,
           sum(CAST(round(l_tax * 100) AS BIGINT)) AS tax_pts
    FROM lineitem WHERE l_returnflag = 'R'
      AND l_orderkey IN (SELECT o_orderkey FROM orders)
    GROUP BY l_orderkey
),
user_surveys AS (
    SELECT l_orderkey AS survey_id,
           l_orderkey AS request_id,
           CAST(floor((1.0 + 4.0 * (discount_pts / CAST(n AS DOUBLE)) / 10.0) * 2.0 + 0.5) / 2.0
                AS DECIMAL(2,1)) AS satisfaction_score,
           CAST(floor((1.0 + (quantity_sum / CAST(n AS DOUBLE)) / 12.5) * 2.0 + 0.5) / 2.0
                AS DECIMAL(2,1)) AS ease_of_use_score,
           CAST(floor((1.0 + (tax_pts / CAST(n AS DOUBLE)) / 2.0) * 2.0 + 0.5) / 2.0
                AS DECIMAL(2,1)) AS response_speed_score,
           CAST(NULL AS VARCHAR) AS comments, CAST(NULL AS TIMESTAMP) AS surveyed_at
    FROM returned
),
type_dept_cells AS (
    SELECT service_type_id, department_id, count(*) AS n
    FROM service_requests
    WHERE service_type_id IS NOT NULL AND department_id IS NOT NULL
    GROUP BY service_type_id, department_id
),
type_owner AS (
    SELECT service_type_id, department_id FROM (
        SELECT *, row_number() OVER (PARTITION BY service_type_id
                                     ORDER BY n DESC, department_id ASC) AS rk
        FROM type_dept_cells) x
    WHERE rk = 1
),
service_types AS (
    SELECT sc.service_type_id, sc.service_code, sc.service_name, o.department_id,
           sc.category, CAST(NULL AS TIMESTAMP) AS created_at
    FROM service_catalog sc LEFT JOIN type_owner o ON o.service_type_id = sc.service_type_id
),
sla_definitions AS (
    SELECT DISTINCT r.sla_id, r.service_type_id, r.priority AS priority_level,
           CAST(lv.days * 24 AS DECIMAL(9,2)) AS sla_hours,
           CAST(NULL AS TIMESTAMP) AS created_at
    FROM service_requests r JOIN sla_levels lv ON lv.priority = r.priority
    WHERE r.sla_id IS NOT NULL
),
dim_department AS (
    SELECT CAST(row_number() OVER (ORDER BY department_id) AS BIGINT) AS dept_key,
           department_id, department_code, department_name, department_sector
    FROM departments
),
dim_service_type AS (
    SELECT CAST(row_number() OVER (ORDER BY service_type_id) AS BIGINT) AS service_key,
           service_type_id, service_code, service_name, category
    FROM service_types
),
dim_sla AS (
    SELECT CAST(row_number() OVER (ORDER BY sla_id) AS BIGINT) AS sla_key,
           sla_id, priority_level, sla_hours,
           CASE WHEN sla_hours <= 24 THEN 'Same Day'
                WHEN sla_hours <= 72 THEN 'Standard'
                WHEN sla_hours <= 168 THEN 'Extended'
                ELSE 'Long Term' END AS sla_category
    FROM sla_definitions
),
calendar_days AS (
    SELECT CAST(unnest(generate_series(
               make_date(CAST(year(min(o_orderdate)) AS INTEGER), 1, 1),
               make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 31),
               INTERVAL 1 DAY)) AS DATE) AS d
    FROM orders
),
dim_time AS (
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_key,
           d AS full_date,
           strftime(d, '%A') AS day_of_week,
           CAST(day(d) AS INTEGER) AS day_num,
           CAST(strftime(d, '%W') AS INTEGER) AS week_num,
           CAST(month(d) AS INTEGER) AS month_num,
           strftime(d, '%B') AS month_name,
           CAST(quarter(d) AS INTEGER) AS quarter_num,
           'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
           CAST(year(d) AS INTEGER) AS year_num,
           CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
           0 AS is_holiday
    FROM calendar_days
),
fact_service_requests AS (
    SELECT request_id AS fact_id, request_id, request_ref, dept_key, service_key,
           year(submitted_at) * 10000 + month(submitted_at) * 100 + day(submitted_at) AS time_key,
           sla_key, channel, status, priority, resolution_minutes, sla_hours AS sla_hours_allowed,
           sla_compliant AS sla_compliant_flag,
           CAST(if(sla_compliant = 0, resolution_minutes - sla_hours * 60, 0) AS DECIMAL(10,2)) AS sla_breach_minutes,
           satisfaction_score, ease_of_use_score, response_speed_score,
           CAST(survey_id IS NOT NULL AS INTEGER) AS has_survey, submitted_at, completed_at
    FROM service_requests
    JOIN (SELECT sla_id, sla_hours FROM sla_definitions) h USING (sla_id)
    JOIN (SELECT sla_id, sla_key FROM dim_sla) l USING (sla_id)
    JOIN (SELECT department_id, dept_key FROM dim_department) o USING (department_id)
    JOIN (SELECT service_type_id, service_key FROM dim_service_type) k USING (service_type_id)
    LEFT JOIN (SELECT request_id, survey_id, satisfaction_score, ease_of_use_score, response_speed_score
               FROM user_surveys) u USING (request_id)
)
"""


def with_star(sql: str) -> str:
    """Prefix ``sql`` (a SELECT, optionally with its own WITH list) with the
    star-schema definitions."""
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {STAR_CTES},\n{body[4:].lstrip()}"
    return f"WITH {STAR_CTES}\n{body}"


# KPI 1-5, written apart from servstar.plans.kpis_sql: raw sums per group first, figures and rounding
# (halves up, to hundredths) from them.
_GROUPED = """
SELECT {keys}, COUNT(*) AS n, COUNT(resolution_minutes) AS n_minutes,
       AVG(resolution_minutes::DOUBLE) / 60 AS hours, MIN(resolution_minutes::DOUBLE) / 60 AS least,
       MAX(resolution_minutes::DOUBLE) / 60 AS most,
       COUNT(sla_compliant_flag) AS judged, COUNT(*) FILTER (sla_compliant_flag = 1) AS met,
       COUNT(*) FILTER (sla_compliant_flag = 0) AS missed, COUNT(*) FILTER (has_survey = 1) AS surveys,
       AVG(satisfaction_score::DOUBLE) AS happy, AVG(ease_of_use_score::DOUBLE) AS ease,
       AVG(response_speed_score::DOUBLE) AS speed, AVG(sla_hours_allowed::DOUBLE) AS allowed
FROM fact_service_requests f, {dims} WHERE {on} GROUP BY ALL"""
_DEPT = ("dim_department o", "f.dept_key = o.dept_key")
_KIND = ("dim_service_type k", "f.service_key = k.service_key")
_DAY = ("dim_time t", "f.time_key = t.time_key")


def _kpi(keys: str, columns: str, *dims, only: str = "true", tail: str = "") -> str:
    inner = _GROUPED.format(keys=keys, dims=", ".join(d for d, _ in dims), on=" AND ".join([*(o for _, o in dims), only]))
    return with_star(f"SELECT {keys}, n AS total_requests, {columns} FROM ({inner}) g {tail}")


def _hundredths(x: str) -> str:
    return f"floor(({x}) * 100.0::DOUBLE + 0.5) / 100.0::DOUBLE"


_PERCENT_MET = _hundredths("CASE WHEN judged > 0 THEN met::DOUBLE / n::DOUBLE * 100 END") + " AS sla_compliance_pct"
KPI_ORACLE = {
    "kpi1_resolution_sql": _kpi(
        "department_name, department_sector",
        f"{_hundredths('hours')} AS avg_resolution_hours, {_hundredths('least')} AS min_resolution_hours, "
        f"{_hundredths('most')} AS max_resolution_hours", _DEPT, only="resolution_minutes IS NOT NULL"),
    "kpi2_sla_sql": _kpi(
        "year_num, month_name, month_num, service_name, category",
        f"CASE WHEN judged > 0 THEN met END AS compliant_count, {_PERCENT_MET}", _DAY, _KIND),
    "kpi3_satisfaction_sql": _kpi(
        "department_name, service_name",
        f"surveys AS survey_count, {_hundredths('happy')} AS avg_satisfaction, {_hundredths('ease')} AS avg_ease_of_use, "
        f"{_hundredths('speed')} AS avg_response_speed, {_PERCENT_MET}, "
        "CASE WHEN happy >= 4 THEN 'High' WHEN happy >= 3 THEN 'Medium' ELSE 'Low' END || ' Satisfaction' "
        "AS satisfaction_band", _DEPT, _KIND, only="has_survey = 1"),
    "kpi4_trend_sql": _kpi(
        "year_num, month_name, month_num, quarter_name",
        f"{_PERCENT_MET}, {_hundredths('happy')} AS avg_satisfaction, {_hundredths('hours')} AS avg_resolution_hours", _DAY),
    "kpi5_top_breach_sql": _kpi(
        "department_name",
        f"missed AS breach_count, {_hundredths('missed::DOUBLE / n::DOUBLE * 100')} AS breach_pct, "
        f"{_hundredths('hours')} AS avg_resolution_hours", _DEPT, tail="ORDER BY missed DESC, department_name LIMIT 5"),
}


# Dashboard datasets, from the same raw sums.
def _mart(keys: str, columns: str, *dims, only: str = "true", more: str = "") -> str:
    inner = _GROUPED.format(keys=keys, dims=", ".join(d for d, _ in dims), on=" AND ".join([*(o for _, o in dims), only]))
    return with_star(f"SELECT *{more} FROM (SELECT {columns} FROM ({inner}) g) m")


def _tenths(x: str) -> str:
    return f"floor(({x}) * 10.0::DOUBLE + 0.5) / 10.0::DOUBLE"


_MET = _tenths("CASE WHEN judged > 0 THEN met::DOUBLE / n::DOUBLE * 100 END")
_SHORT = "replace(department_name, 'Ministry of ', '') AS department_name"
MART_ORACLE = {
    "mart_requests_per_dept": _mart("department_name", f"{_SHORT}, n AS total_requests", _DEPT),
    "mart_sla_trend": _mart(
        "year_num, month_num, month_name",
        f"year_num, month_num, month_name, {_MET} AS sla_pct, left(month_name, 3) || ' ' || year_num AS period", _DAY,
        more=", 80.0::DOUBLE AS sla_target_pct, CAST(coalesce(sla_pct >= 80.0, false) AS INTEGER) AS on_target"),
    "mart_satisfaction_vs_sla": _mart(
        "department_name", f"{_SHORT}, {_hundredths('happy')} AS avg_satisfaction, {_MET} AS sla_pct, n AS total_requests",
        _DEPT, only="has_survey = 1",
        more=", 75.0::DOUBLE AS sla_target_pct, 3.5::DOUBLE AS satisfaction_target, "
             "CAST(coalesce(sla_pct >= 75.0 AND avg_satisfaction >= 3.5, false) AS INTEGER) AS on_target"),
    "mart_resolution_vs_sla": _mart(
        "department_name", f"{_SHORT}, {_tenths('hours')} AS avg_hours, {_tenths('allowed')} AS sla_hours", _DEPT),
}
_ALL = ("(SELECT 1 AS every) x", "true")
_SHARE_MET = "CASE WHEN judged > 0 THEN met::DOUBLE / n::DOUBLE * 100 END"
MART_ORACLE |= {
    "mart_kpi_tiles": _mart(
        "every", f"n AS total_requests, {_MET} AS sla_compliance_pct, {_hundredths('happy')} AS avg_satisfaction, "
        f"{_tenths('hours')} AS avg_resolution_hours", _ALL,
        more=", format('{:,}', total_requests) AS total_requests_text, sla_compliance_pct || '%' AS sla_compliance_text, "
             "avg_satisfaction || ' / 5.0' AS avg_satisfaction_text, avg_resolution_hours || ' hrs' AS avg_resolution_text"),
    "load_snapshot": _mart(
        "every", f"n AS total_rows, {_hundredths(_SHARE_MET)} AS sla_compliance_pct, {_hundredths('happy')} AS avg_satisfaction, "
        f"{_hundredths('hours')} AS avg_resolution_hours", _ALL),
}


# Frame KPIs, from the same raw sums: NULL keys dropped, ties to even, flag means.
def _even(x: str) -> str:
    return f"round_even(({x}) * 100.0::DOUBLE, 0) / 100.0::DOUBLE"


def _frame(keys: str, columns: str, *dims, only: str = "true", more: str = "") -> str:
    known = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return _mart(keys, f"{keys}, n AS total_requests, {columns}", *dims, only=f"{only} AND {known}", more=more)


_MEAN_MET = _even("met::DOUBLE / judged::DOUBLE * 100") + " AS sla_compliance_pct"
FRAME_ORACLE = {
    "kpi1_resolution_frame": _frame(
        "department_name, department_sector", f"{_even('hours')} AS avg_resolution_hours, {_even('least')} AS min_resolution_hours, "
        f"{_even('most')} AS max_resolution_hours", _DEPT),
    "kpi2_sla_frame": _frame(
        "year_num, month_num, month_name, service_name",
        f"met AS compliant_count, {_even('met::DOUBLE / n::DOUBLE * 100')} AS sla_compliance_pct", _DAY, _KIND),
    "kpi3_satisfaction_frame": _frame(
        "department_name, service_name", f"{_even('happy')} AS avg_satisfaction, {_even('ease')} AS avg_ease_of_use, "
        f"{_even('speed')} AS avg_response_speed, {_MEAN_MET}", _DEPT, _KIND, only="has_survey = 1",
        more=", CASE WHEN avg_satisfaction >= 4 THEN 'High' WHEN avg_satisfaction >= 3 THEN 'Medium' ELSE 'Low' END AS satisfaction_band"),
    "kpi4_trend_frame": _frame(
        "year_num, month_num, month_name, quarter_name",
        f"{_MEAN_MET}, {_even('happy')} AS avg_satisfaction, {_even('hours')} AS avg_resolution_hours", _DAY),
}
FRAME_ORACLE["kpi1_preview"] = FRAME_ORACLE["kpi1_resolution_frame"] + (
    " ORDER BY avg_resolution_hours NULLS LAST, department_name, department_sector LIMIT 4")


# Declared keys, NOT NULL columns and foreign keys, fixed values written out apart from the library's declarations.
KEY_COLUMNS = {
    "departments": ("department_id", "department_code"), "service_types": ("service_type_id", "service_code"),
    "sla_definitions": ("sla_id",), "service_requests": ("request_id", "request_ref"),
    "user_surveys": ("survey_id", "request_id"), "dim_department": ("dept_key",), "dim_service_type": ("service_key",),
    "dim_sla": ("sla_key",), "dim_time": ("time_key",), "fact_service_requests": ("fact_id",),
}
REQUIRED_COLUMNS = {
    "departments": "department_id department_code department_name",
    "service_types": "service_type_id service_code service_name department_id",
    "sla_definitions": "sla_id service_type_id priority_level sla_hours",
    "service_requests": "request_id request_ref department_id service_type_id sla_id submitted_at",
    "user_surveys": "survey_id request_id satisfaction_score",
    "dim_department": "dept_key department_id department_code department_name",
    "dim_service_type": "service_key service_type_id service_code service_name",
    "dim_sla": "sla_key sla_id priority_level sla_hours",
    "dim_time": "time_key full_date",
    "fact_service_requests": "fact_id request_id request_ref dept_key service_key time_key sla_key",
}
#: child table, parent table, and the column that both have.
REFERENCES = (
    ("service_types", "departments", "department_id"), ("sla_definitions", "service_types", "service_type_id"),
    ("service_requests", "departments", "department_id"), ("service_requests", "service_types", "service_type_id"),
    ("service_requests", "sla_definitions", "sla_id"), ("user_surveys", "service_requests", "request_id"),
    ("fact_service_requests", "dim_department", "dept_key"), ("fact_service_requests", "dim_service_type", "service_key"),
    ("fact_service_requests", "dim_time", "time_key"), ("fact_service_requests", "dim_sla", "sla_key"),
)
EVENT_PRIORITY = "list_extract(['NORMAL', 'HIGH', 'LOW', 'URGENT'], CAST(json_extract(props, '$.k') AS BIGINT) % 4 + 1)"
