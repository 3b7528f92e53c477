"""KPI edge cases on hand-built star frames, and identities on the given data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from servstar.plans import kpis_frame, kpis_sql, marts

DEPT = "dept_key long, department_id long, department_name string, department_sector string"
SVC = "service_key long, service_name string, category string"
TIME = ("time_key int, year_num int, month_num int, month_name string, quarter_name string")


@pytest.fixture()
def sess(spark):
    """A separate session, so hand-built views do not replace the stored ones."""
    return spark.newSession()


def _fact(spark, n, dept, svc, sat, flag, res=None, survey=1, time_key=20240105):
    """n fact rows; ``sat``/``flag``/``res`` are Column expressions over ``id``."""
    return spark.range(n).select(
        (F.col("id") + F.lit(dept * 100000)).alias("fact_id"),
        F.lit(dept).cast("long").alias("dept_key"), F.lit(svc).cast("long").alias("service_key"),
        F.lit(time_key).alias("time_key"),
        (res if res is not None else F.lit(600)).cast("decimal(10,2)").alias("resolution_minutes"),
        F.lit(24).cast("decimal(9,2)").alias("sla_hours_allowed"),
        flag.cast("int").alias("sla_compliant_flag"),
        F.lit(survey).alias("has_survey"),
        sat.cast("decimal(2,1)").alias("satisfaction_score"),
        sat.cast("decimal(2,1)").alias("ease_of_use_score"),
        sat.cast("decimal(2,1)").alias("response_speed_score"))


def _dims(spark):
    dept = spark.createDataFrame([(1, 10, "Ministry of Health", "Public"),
                                  (2, 20, "Ministry of Transport", None),
                                  (3, 30, "Ministry of Finance", "Public")], DEPT)
    svc = spark.createDataFrame([(1, "Permit", "Line"), (2, "Licence", "Size")], SVC)
    time = spark.createDataFrame([(20240105, 2024, 1, "January", "Q1")], TIME)
    return dept, svc, time


def _views(spark, fact, dept, svc, time):
    fact.createOrReplaceTempView("fact_service_requests")
    dept.createOrReplaceTempView("dim_department")
    svc.createOrReplaceTempView("dim_service_type")
    time.createOrReplaceTempView("dim_time")


def test_band_rounding_gap_differs_between_sql_and_frame(sess):
    dept, svc, time = _dims(sess)
    # 399 x 4.0 and 1 x 3.0: average 3.9975 -> rounds to 4.0
    fact = _fact(sess, 400, 1, 1, F.when(F.col("id") == 0, 3.0).otherwise(4.0), F.lit(1))
    _views(sess, fact, dept, svc, time)
    sql = sess.sql(kpis_sql.KPI3_SATISFACTION).first()
    frame = kpis_frame.kpi3_satisfaction(fact, dept, svc).first()
    assert sql.avg_satisfaction == 4.0 and frame.avg_satisfaction == 4.0
    assert sql.satisfaction_band == "Medium Satisfaction"   # unrounded 3.9975
    assert frame.satisfaction_band == "High"                # rounded 4.0


def test_null_flag_denominator_ratio_vs_mean(sess):
    dept, svc, time = _dims(sess)
    flag = (F.when(F.col("id") == 1, F.lit(None))
             .when(F.col("id") == 2, F.lit(0)).otherwise(F.lit(1)))
    fact = _fact(sess, 4, 1, 1, F.lit(3.0), flag)
    _views(sess, fact, dept, svc, time)
    sql = sess.sql(kpis_sql.KPI3_SATISFACTION).first()
    frame = kpis_frame.kpi3_satisfaction(fact, dept, svc).first()
    assert sql.sla_compliance_pct == 50.0        # 2 / 4 rows
    assert frame.sla_compliance_pct == 66.67     # mean over the 3 non-NULL flags


def test_kpi1_null_resolution_and_null_sector(sess):
    dept, svc, time = _dims(sess)
    res = F.when(F.col("id") == 0, F.lit(None)).otherwise(F.lit(120))
    fact = (_fact(sess, 3, 1, 1, F.lit(3.0), F.lit(1), res=res)
            .unionByName(_fact(sess, 2, 2, 1, F.lit(3.0), F.lit(1))))
    _views(sess, fact, dept, svc, time)
    sql = {r.department_name: r for r in sess.sql(kpis_sql.KPI1_RESOLUTION).collect()}
    frame = {r.department_name: r for r in kpis_frame.kpi1_resolution(fact, dept).collect()}
    # SQL filters NULL resolution: 2 of 3 rows; frame counts all 3
    assert sql["Ministry of Health"].total_requests == 2
    assert frame["Ministry of Health"].total_requests == 3
    assert frame["Ministry of Health"].avg_resolution_hours == 2.0
    # NULL sector: SQL keeps the group, frame drops it
    assert "Ministry of Transport" in sql and "Ministry of Transport" not in frame


def test_kpi5_ties_at_rank_five_break_by_name(sess):
    names = ["Zeta", "Alpha", "Mu", "Beta", "Kappa", "Gamma"]
    dept = sess.createDataFrame([(i + 1, i, n, "S") for i, n in enumerate(names)], DEPT)
    _, svc, time = _dims(sess)
    fact = None
    for i, _n in enumerate(names):
        part = _fact(sess, 3, i + 1, 1, F.lit(3.0), F.lit(0))   # 3 breaches each
        fact = part if fact is None else fact.unionByName(part)
    _views(sess, fact, dept, svc, time)
    got = [r.department_name for r in sess.sql(kpis_sql.KPI5_TOP_BREACH).collect()]
    assert got == ["Alpha", "Beta", "Gamma", "Kappa", "Mu"]


def test_marts_strip_prefix_and_tiles(sess):
    dept, svc, time = _dims(sess)
    fact = (_fact(sess, 3, 1, 1, F.lit(4.0), F.lit(1))
            .unionByName(_fact(sess, 1, 3, 2, F.lit(2.0), F.lit(0), survey=0)))
    per = {r.department_name: r.total_requests
           for r in marts.requests_per_dept(fact, dept).collect()}
    assert per == {"Health": 3, "Finance": 1}
    t = marts.kpi_tiles(fact).first()
    assert t.total_requests == 4 and t.sla_compliance_pct == 75.0
    assert t.avg_satisfaction == 4.0           # surveyed rows only
    assert (t.total_requests_text, t.sla_compliance_text, t.avg_satisfaction_text,
            t.avg_resolution_text) == ("4", "75.0%", "4.0 / 5.0", "10.0 hrs")


def test_identities_on_given_data(spark):
    """KPI 2 rolled up by month equals the trend; request totals agree."""
    from servstar.plans.warehouse import warehouse
    wh = warehouse(spark, SF001)
    k1 = kpis_sql.run_kpi(spark, SF001, "kpi1_resolution_sql")
    k2 = kpis_sql.run_kpi(spark, SF001, "kpi2_sla_sql")
    k4 = kpis_sql.run_kpi(spark, SF001, "kpi4_trend_sql")
    fact_rows = wh.fact_service_requests.count()
    assert k2.agg(F.sum("total_requests")).first()[0] == fact_rows
    assert k4.agg(F.sum("total_requests")).first()[0] == fact_rows
    completed = wh.fact_service_requests.where("resolution_minutes IS NOT NULL").count()
    assert k1.agg(F.sum("total_requests")).first()[0] == completed
    rolled = (k2.groupBy("year_num", "month_num")
                .agg(F.sum("total_requests").alias("n"), F.sum("compliant_count").alias("c")))
    trend = k4.select("year_num", "month_num", "total_requests", "sla_compliance_pct")
    diff = (rolled.join(trend, ["year_num", "month_num"], "full")
            .where((F.col("n") != F.col("total_requests"))
                   | (F.abs(F.col("c") / F.col("n") * 100 - F.col("sla_compliance_pct")) > 0.0051)))
    assert diff.count() == 0


def test_given_data_figures(spark):
    """Figures recorded for sf0.01 in FIXTURES.md."""
    from servstar.plans.warehouse import warehouse
    wh = warehouse(spark, SF001)
    r = wh.service_requests
    assert r.count() == 15000
    assert r.where("service_type_id IS NULL").count() == 257
    assert r.where("completed_at IS NOT NULL").count() == 11650
    assert r.where("sla_compliant = 1").count() == 5960
    assert wh.user_surveys.count() == 11058
    # every request is either in the fact or in the quarantine, with its reason
    q = wh.table("_quarantine/fact_orphans")
    assert q.count() == 257 and wh.fact_service_requests.count() == 15000 - 257
    assert {r.missing_keys for r in q.select("missing_keys").distinct().collect()} == \
        {"service_type,sla"}


def test_fact_paths_agree(spark):
    """The load's staging path gives the same fact rows as requests LEFT JOIN
    surveys (the general path)."""
    from servstar.operators import fact
    from servstar.plans.warehouse import warehouse
    wh = warehouse(spark, SF001)
    cols = [c for c in wh.fact_service_requests.columns if c != "load_timestamp"]
    joined = fact.build_fact(wh.service_requests, wh.user_surveys, wh.dim_department,
                             wh.dim_service_type, wh.dim_sla).select(*cols)
    stored = wh.fact_service_requests.select(*cols)
    assert joined.count() == stored.count()
    assert joined.exceptAll(stored).count() == 0 and stored.exceptAll(joined).count() == 0
