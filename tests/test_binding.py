"""Binding rules on a hand-written set of given tables."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from servstar.operators import dims
from servstar.session import scratch_path
from servstar.sources import binding
from servstar.sources.tables import SourceTables

D = dt.datetime


@pytest.fixture(scope="module")
def src(spark):
    root = scratch_path(spark, "given")
    spark.createDataFrame([(0, "AFRICA"), (1, "ASIA")], "r_regionkey int, r_name string") \
         .write.parquet(f"{root}/region.parquet")
    spark.createDataFrame([(0, "NATION_0", 0), (1, "NATION_1", 1), (2, "NATION_2", 9)],
                          "n_nationkey int, n_name string, n_regionkey int") \
         .write.parquet(f"{root}/nation.parquet")
    spark.createDataFrame([(10, "C10", 0, 1.0, "AUTOMOBILE"), (11, "C11", 1, 1.0, "BUILDING")],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                          "c_mktsegment string").write.parquet(f"{root}/customer.parquet")
    spark.createDataFrame([(100, "p", "b", "SMALL", 1, 1.0), (101, "p", "b", "ECONOMY", 1, 1.0),
                           (102, "p", "b", "SMALL", 1, 1.0)],
                          "p_partkey long, p_name string, p_brand string, p_type string, "
                          "p_size int, p_retailprice double").write.parquet(f"{root}/part.parquet")
    o = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, " \
        "o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame([
        (1, 10, "F", 1.0, D(1996, 1, 10), "1-URGENT"),   # ships before and after
        (2, 10, "O", 1.0, D(1996, 1, 10), "1-URGENT"),   # ships only before: open
        (3, 11, "O", 1.0, D(1996, 3, 1), "5-LOW"),       # no lines
        (4, 11, "F", 1.0, D(1996, 1, 1), "1-URGENT"),    # exactly 90 days: compliant
        (5, 11, "F", 1.0, D(1996, 1, 1), "1-URGENT"),    # 91 days: breach
    ], o).write.parquet(f"{root}/orders.parquet")
    li = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, " \
         "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, " \
         "l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame([
        (1, 101, 1, 1, 10.0, 1.0, 0.05, 0.02, "R", "F", D(1996, 1, 5)),
        (1, 100, 1, 2, 20.0, 1.0, 0.07, 0.04, "R", "F", D(1996, 1, 20)),
        (1, 102, 1, 3, 30.0, 1.0, 0.00, 0.00, "N", "F", D(1996, 1, 15)),
        (2, 101, 1, 1, 5.0, 1.0, 0.01, 0.01, "A", "F", D(1996, 1, 1)),
        (4, 102, 1, 1, 5.0, 1.0, 0.01, 0.01, "N", "F", D(1996, 3, 31)),
        (5, 102, 1, 1, 5.0, 1.0, 0.01, 0.01, "N", "F", D(1996, 4, 1)),
    ], li).write.parquet(f"{root}/lineitem.parquet")
    return SourceTables(spark, root)


def _by_id(df, key="request_id"):
    return {r[key]: r for r in df.collect()}


def test_requests(src):
    r = _by_id(binding.service_requests(src))
    assert set(r) == {1, 2, 3, 4, 5}
    # service: the type of the smallest part key (100 -> SMALL), ids by sorted type
    cat = {x.service_code: x.service_type_id for x in binding.service_catalog(src).collect()}
    assert cat == {"ECONOMY": 1, "SMALL": 2}
    assert r[1].service_type_id == 2 and r[2].service_type_id == 1
    assert r[1].sla_id == 2 * 10 + 1 and r[3].sla_id is None and r[3].service_type_id is None
    # completed: first ship day on/after the order day
    assert r[1].completed_at == D(1996, 1, 15)
    assert r[1].resolution_minutes == decimal.Decimal(5 * 1440)
    assert r[2].completed_at is None and r[2].resolution_minutes is None
    assert r[2].sla_compliant == 0
    assert (r[4].sla_compliant, r[5].sla_compliant) == (1, 0)
    assert r[4].sla_deadline == D(1996, 3, 31)
    assert (r[1].department_id, r[1].channel, r[1].status, r[1].request_ref) == \
        (0, "AUTOMOBILE", "F", "REQ-1")


def test_surveys(src):
    s = _by_id(binding.user_surveys(src))
    assert set(s) == {1}        # only order 1 has returned lines
    # returned lines of order 1: discount 5 and 7 points, quantity 10 and 20, tax 2 and 4
    d, q, t = 6.0, 15.0, 3.0
    half = lambda x: float(int(x * 2 + 0.5)) / 2
    assert float(s[1].satisfaction_score) == half(1 + 4 * d / 10)
    assert float(s[1].ease_of_use_score) == half(1 + q / 12.5)
    assert float(s[1].response_speed_score) == half(1 + t / 2)
    staged = _by_id(binding.surveys_from_staging(binding.request_staging(src)))
    drop = lambda r: tuple(v for k, v in r.asDict().items() if k != "surveyed_at")
    assert {k: drop(v) for k, v in staged.items()} == {k: drop(v) for k, v in s.items()}


def test_departments_service_owner_and_slas(src):
    deps = _by_id(binding.departments(src), "department_id")
    assert deps[0].department_code == "N0" and deps[0].department_sector == "AFRICA"
    assert deps[2].department_sector is None       # region not found: left join keeps it
    req = binding.service_requests(src)
    st = _by_id(binding.service_types(binding.service_catalog(src), req), "service_type_id")
    # SMALL: requests 1 (dept 0), 4 and 5 (dept 1) -> dept 1; ECONOMY: request 2 (dept 0)
    assert st[2].department_id == 1 and st[1].department_id == 0
    assert (st[2].category, st[1].category) == ("Size", "Line")
    sla = _by_id(binding.sla_definitions(req), "sla_id")
    assert set(sla) == {21, 11}
    assert int(sla[21].sla_hours) == 90 * 24


def test_calendar_covers_whole_years(spark, src):
    cal = dims.dim_time(binding.calendar_bounds(src))
    days = cal.agg(F.min("full_date").alias("a"), F.max("full_date").alias("b"),
                   F.count(F.lit(1)).alias("n")).first()
    assert (days.a, days.b, days.n) == (dt.date(1996, 1, 1), dt.date(1996, 12, 31), 366)
