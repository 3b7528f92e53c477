"""Every registered query against its DuckDB oracle (row count, columns,
values), on the smallest given tables; the driver repeats this at sf0.01."""

from __future__ import annotations

import pytest

from conftest import SF0001


def test_every_query_has_an_oracle():
    from servstar.registry import ORACLE_SQL, QUERIES
    missing = sorted(set(QUERIES) - set(ORACLE_SQL))
    assert missing == []


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["department_name", "department_sector", "total_requests",
                          "avg_resolution_hours", "min_resolution_hours",
                          "max_resolution_hours"]
    assert df.count() > 0


@pytest.mark.parametrize("group", ["kpi", "dim", "other"])
def test_queries_match_duckdb(spark, group):
    import oracle_check
    from servstar.registry import QUERIES
    names = sorted(QUERIES)
    pick = {
        "kpi": [n for n in names if n.startswith(("kpi", "mart_", "load_"))],
        "dim": [n for n in names if n.startswith(("dim_", "fact_", "sla_"))
                or n in ("departments", "service_types", "service_requests", "user_surveys")],
    }
    pick["other"] = [n for n in names if n not in pick["kpi"] + pick["dim"]]
    assert oracle_check.compare(spark, SF0001, pick[group], verbose=False) == []


def test_queries_from_a_second_session(spark):
    """Another session of the same application reuses the written tables and
    gets its own views."""
    from __spark_entry__ import queries
    other = spark.newSession()
    q = queries()
    for name in ("kpi1_resolution_sql", "kpi2_sla_frame", "stream_total"):
        a = sorted(map(tuple, q[name](spark, SF0001).collect()))
        b = sorted(map(tuple, q[name](other, SF0001).collect()))
        assert a == b and a


@pytest.mark.parametrize("name, key", [
    ("kpi1_resolution_sql", lambda r: r.avg_resolution_hours),
    ("kpi2_sla_sql", lambda r: (r.year_num, r.month_num, -r.sla_compliance_pct)),
    ("kpi3_satisfaction_sql", lambda r: -r.avg_satisfaction),
    ("kpi4_trend_sql", lambda r: (r.year_num, r.month_num)),
    ("kpi5_top_breach_sql", lambda r: (-r.breach_count, r.department_name)),
    ("kpi1_resolution_frame", lambda r: r.avg_resolution_hours),
    ("kpi2_sla_frame", lambda r: (r.year_num, r.month_num, r.service_name)),
    ("kpi3_satisfaction_frame", lambda r: -r.avg_satisfaction),
    ("kpi4_trend_frame", lambda r: (r.year_num, r.month_num)),
    ("mart_sla_trend", lambda r: (r.year_num, r.month_num)),
    ("stream_by_department", lambda r: r.department),
    ("stream_by_priority", lambda r: r.priority),
])
def test_result_order(spark, name, key):
    """The declared order, which the comparison of row multisets doesn't see."""
    from servstar.registry import QUERIES
    keys = [key(r) for r in QUERIES[name](spark, SF0001).collect()]
    assert len(keys) > 1 and keys == sorted(keys)
