"""The fact by month and its summary: same rows as over the fact, only changed months rewritten, no fact scan, pruning."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001


def _facts(spark, n: int):
    """Facts with NULL flags, minutes and scores, of which half a month has none at all."""
    k = F.col("id")
    day = F.expr("19950101 + (id % 3) * 100 + id % 28").cast("int")
    none = (k % 5 == 0) | (F.expr("id % 3 = 2 and id % 28 < 14"))
    from servstar import schemas
    return schemas.conform(spark.range(n).select(
        k.alias("fact_id"), k.alias("request_id"), k.cast("string").alias("request_ref"), (k % 3 + 1).alias("dept_key"),
        (k % 2 + 1).alias("service_key"), day.alias("time_key"), F.lit(1).alias("sla_key"),
        F.when(~none, (k * 37 % 9000 + 0.25)).alias("resolution_minutes"), F.lit(24).alias("sla_hours_allowed"),
        F.when(k % 7 != 0, k % 2).alias("sla_compliant_flag"), F.when(k % 4 == 0, 1 + k % 9 / 2).alias("satisfaction_score"),
        F.when(k % 8 == 0, 1 + k % 9 / 2).alias("ease_of_use_score"), F.when(k % 11 != 0, (k % 4 == 0).cast("int")).alias("has_survey")),
        schemas.FACT_SERVICE_REQUESTS)


def _files(root: str) -> dict:
    return {d: sorted(os.listdir(f"{root}/{d}")) for d in os.listdir(root) if d.startswith("month=")}


@pytest.mark.parametrize("n", [0, 1, 4000])
def test_frames_equal_those_over_the_fact(spark, tmp_path, n):
    from servstar.plans import kpis_frame, marts, summary
    fact, root = _facts(spark, n), str(tmp_path / "months")
    summary.maintain(spark, fact, root)
    cells = summary.Months(spark, root).cells
    days = fact.select("time_key").distinct().selectExpr(
        "time_key", "1995 as year_num", "time_key div 100 % 100 as month_num", "concat('M', time_key div 100) as month_name",
        "cast(null as string) as missing", "'Q1' as quarter_name")
    dims = {"dim_department": spark.createDataFrame([(1, "Ministry of A", "x"), (2, "B", None), (3, "C", "y")],
                                                    "dept_key long, department_name string, department_sector string"),
            "dim_service_type": spark.createDataFrame([(1, "s", "c"), (2, None, "c")],
                                                      "service_key long, service_name string, category string"), "dim_time": days}
    for name, (build, *needs) in summary.FRAMES.items():
        plain = getattr(kpis_frame if name.startswith("kpi") else marts, name.removesuffix("_frame").removeprefix("mart_"))
        needed = [dims[d] for d in needs]
        got, want = build(cells, *needed), plain(fact, *needed)
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect())), name


def test_statements_equal_those_over_the_fact(spark, tmp_path):
    from servstar.plans import kpis_sql, summary
    fact, root = _facts(spark, 3000), str(tmp_path / "months")
    summary.maintain(spark, fact, root)
    ss = spark.newSession()
    at = str(tmp_path / "fact")
    fact.write.parquet(at)
    ss.read.parquet(at).createOrReplaceTempView("fact_service_requests")
    summary.Months(ss, root).cells.createOrReplaceTempView("request_cells")
    ss.range(1, 4).selectExpr("id as dept_key", "concat('D', id) as department_name", "nullif('S', concat('S', id - 2)) as department_sector") \
        .createOrReplaceTempView("dim_department")
    ss.range(1, 3).selectExpr("id as service_key", "concat('T', id) as service_name", "'c' as category").createOrReplaceTempView("dim_service_type")
    ss.read.parquet(at).select("time_key").distinct().selectExpr(
        "time_key", "1995 as year_num", "time_key div 100 % 100 as month_num", "'m' as month_name", "'Q1' as quarter_name") \
        .createOrReplaceTempView("dim_time")
    for name in kpis_sql.KPI_SQL:
        got, want = ss.sql(summary.KPI_SQL[name]), ss.sql(kpis_sql.KPI_SQL[name])
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), name


def test_only_months_that_changed_are_rewritten(spark, tmp_path):
    from servstar.plans import summary
    fact, root = _facts(spark, 2000), str(tmp_path / "months")
    first = summary.maintain(spark, fact, root)
    assert (first["new_rows"], first["months_summed"]) == (2000, 3)
    before = _files(f"{root}/cells")
    again = summary.maintain(spark, fact.withColumn("load_timestamp", F.current_timestamp()), root)
    assert not any(again.values()) and _files(f"{root}/cells") == before
    later = fact.withColumn("sla_compliant_flag", F.when(F.col("fact_id") == 1, 0).otherwise(F.col("sla_compliant_flag")))
    third = summary.maintain(spark, later, root)
    after = _files(f"{root}/cells")
    assert (third["changed_rows"], third["months_written"], third["months_summed"]) == (1, 1, 1)
    assert [d for d in after if after[d] != before[d]] == ["month=199502"]
    # a month whose facts are gone leaves the summary
    fourth = summary.maintain(spark, later.filter("time_key div 100 <> 199503"), root)
    assert fourth["months_summed"] == 1 and set(_files(f"{root}/cells")) == {"month=199501", "month=199502"}


def test_a_load_that_broke_off_is_completed(spark, tmp_path):
    from servstar.plans import summary
    from servstar.plans.incremental import upsert
    fact, root = _facts(spark, 2000), str(tmp_path / "months")
    summary.maintain(spark, fact, root)
    more = _facts(spark, 2100)
    upsert(summary.by_month(more), f"{root}/facts", "fact_id", summary.FACTS)  # and no refresh
    done = summary.maintain(spark, more, root)
    assert done["new_rows"] == 0 and done["months_summed"] == 3
    cells = summary.Months(spark, root).cells
    assert cells.agg(F.sum("requests")).first()[0] == 2100
    want = summary.cells_of(summary.by_month(more))
    assert sorted(map(repr, cells.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_no_kpi_scans_the_fact(spark):
    from __spark_entry__ import queries
    for name, run in queries().items():
        if name.endswith("_summary"):
            scans = [ln for ln in run(spark, SF0001)._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in ln]
            assert scans and not [ln for ln in scans if "_months/facts" in ln or "fact_service_requests" in ln], name


def test_one_year_reads_twelve_months(spark):
    from __spark_entry__ import queries
    df = queries()["kpi2_of_year"](spark, SF0001)
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()
    df.collect()
    read = []

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        elif node.nodeName().startswith("Scan parquet") and "dynamicpruning" in node.toString():
            read.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    assert read == [12]
