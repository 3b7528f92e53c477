"""Plan shape: the properties the scale argument rests on (README, "Design for
scale"), checked on the physical plans so a change that breaks them fails."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF0001

KPI_QUERIES = ["kpi1_resolution_sql", "kpi2_sla_sql", "kpi3_satisfaction_sql", "kpi4_trend_sql",
               "kpi5_top_breach_sql", "kpi1_resolution_frame", "kpi2_sla_frame",
               "kpi3_satisfaction_frame", "kpi4_trend_frame", "mart_requests_per_dept",
               "mart_sla_trend", "mart_satisfaction_vs_sla", "mart_resolution_vs_sla"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _fact_read_schema(plan: str) -> str:
    for line in plan.splitlines():
        # the fact is the one table partitioned by loaded
        if "FileScan" in line and "loaded" in line:
            return re.search(r"FileScan parquet \[([^\]]*)\]", line).group(1)
    raise AssertionError("no fact scan in plan")


@pytest.mark.parametrize("name", KPI_QUERIES)
def test_kpi_plans_broadcast_prune_and_combine(spark, name):
    from __spark_entry__ import queries
    plan = _plan(queries()[name](spark, SF0001))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "partial_" in plan                      # map-side combine before the shuffle
    schema = _fact_read_schema(plan)
    for unused in ("request_ref", "channel", "priority", "submitted_at", "completed_at"):
        assert unused not in schema, (unused, schema)


def test_survey_filter_reaches_the_scan(spark):
    from __spark_entry__ import queries
    for name in ("kpi3_satisfaction_sql", "kpi3_satisfaction_frame"):
        plan = _plan(queries()[name](spark, SF0001))
        assert "EqualTo(has_survey,1)" in plan


def test_load_fact_build_does_not_shuffle_requests(spark):
    from servstar.operators import fact
    from servstar.plans.warehouse import warehouse
    wh = warehouse(spark, SF0001)
    staging = spark.read.parquet(wh.path("_staging/requests"))
    df = fact.build_fact_from_staging(staging, wh.dim("dim_department"),
                                      wh.dim("dim_service_type"), wh.dim("dim_sla"))
    plan = _plan(df)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_staging_never_shuffles_by_part_type(spark):
    """One line-sized shuffle; the type is looked up per part, with broadcasts of part off."""
    from servstar.plans.warehouse import warehouse
    from servstar.sources import binding
    from servstar.sources.tables import SourceTables
    ss = spark.newSession()
    ss.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    catalog = F.broadcast(ss.read.parquet(warehouse(spark, SF0001).path("service_catalog")))
    plan = _plan(binding.request_staging(SourceTables(ss, SF0001), catalog=catalog))
    shuffles = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert not [ln for ln in shuffles if "p_type" in ln]
    assert len([ln for ln in shuffles if "hashpartitioning(l_orderkey" in ln]) == 1


def test_fact_and_quarantine_come_from_one_scan(spark):
    from servstar.operators import fact
    from servstar.plans.warehouse import warehouse
    wh = warehouse(spark, SF0001)
    staging = spark.read.parquet(wh.path("_staging/requests"))
    df = fact.fact_and_orphans(staging, *[wh.dim(d) for d in ("dim_department", "dim_service_type", "dim_sla", "dim_time")])
    plan = _plan(df)
    assert plan.count("FileScan") == 5 and "hashpartitioning" not in plan  # staging and four dimensions
    # no submit date: no calendar day, so quarantine
    late = fact.fact_and_orphans(staging.withColumn("submitted_at", F.lit(None).cast("timestamp_ntz")), *[
        wh.dim(d) for d in ("dim_department", "dim_service_type", "dim_sla", "dim_time")])
    assert late.where("loaded = 1").count() == 0
    assert late.where("missing_keys NOT LIKE '%time'").count() == 0


def test_line_aggregate_combines_map_side(spark):
    from servstar.sources import binding
    from servstar.sources.tables import SourceTables
    plan = _plan(binding.order_lines(SourceTables(spark, SF0001)))
    assert plan.count("ObjectHashAggregate") >= 2 and "partial_collect_set" in plan


def test_orphan_report_scans_the_fact_once(spark):
    from __spark_entry__ import queries
    df = queries()["dq_orphans"](spark, SF0001)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    scans = [ln for ln in final.splitlines() if "FileScan" in ln and "loaded#" in ln]
    assert len(scans) == 1        # four foreign keys, one pass
