"""Data-quality checks, sinks, the load-once guard, the declared flow."""

from __future__ import annotations

import decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from servstar.operators import quality
from servstar.plans import flow
from servstar.session import scratch_path
from servstar.sources.tables import load_if_empty, read_csv, write_csv


def test_key_profile_finds_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,), (3,), (3,), (None,)], "k long")
    r = quality.key_profile(df, "t", ["k"]).first()
    assert (r.total_rows, r.distinct_keys, r.null_key_rows, r.duplicated_keys,
            r.duplicated_rows) == (7, 4, 1, 2, 5)
    dups = {x.k: x.n for x in quality.duplicate_rows(df, ["k"]).collect()}
    assert dups == {2: 2, 3: 3}


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (None, None)], "a long, b string")
    got = {r.column_name: r.null_count
           for r in quality.null_counts(df, "t", ["a", "b"]).collect()}
    assert got == {"a": 2, "b": 2}


def test_orphans_and_split(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None), (13, 2)], "cid long, pid long")
    assert [r.cid for r in quality.orphans(child, "pid", parent, "id").collect()] == [11]
    valid, bad = quality.split_valid(child, "pid", parent, "id")
    assert sorted(r.cid for r in valid.collect()) == [10, 13]
    assert sorted(r.cid for r in bad.collect()) == [11, 12]
    rep = quality.orphan_report({"service_requests": child.withColumnRenamed("pid", "sla_id"),
                                 "sla_definitions": parent.withColumnRenamed("id", "sla_id")})
    r = rep.first()
    assert (r.child_table, r.checked_rows, r.null_rows, r.orphan_rows) == \
        ("service_requests", 4, 1, 1)


def test_score_range(spark):
    D = decimal.Decimal
    s = spark.createDataFrame([(D("1.0"), D("5.0"), None), (D("0.5"), D("5.5"), D("3.0")),
                               (D("4.5"), None, D("6.0"))],
                              "satisfaction_score decimal(2,1), ease_of_use_score decimal(2,1), "
                              "response_speed_score decimal(2,1)")
    got = {r.column_name: (r.checked, r.out_of_range) for r in quality.score_range(s).collect()}
    assert got == {"satisfaction_score": (3, 1), "ease_of_use_score": (2, 1),
                   "response_speed_score": (2, 1)}
    assert quality.out_of_range_rows(s).count() == 2


def test_csv_roundtrip_keeps_nulls_and_values(spark):
    from servstar.plans.sinks import KPI1_CSV_SCHEMA
    df = spark.createDataFrame([("A", None, 3, 1.25, 0.5, 2.0), ("B", "S", 1, None, None, None)],
                               KPI1_CSV_SCHEMA)
    path = scratch_path(spark, "csv-test")
    write_csv(df, path)
    back = read_csv(spark, path, KPI1_CSV_SCHEMA)
    assert sorted(back.collect()) == sorted(df.collect())


def test_load_if_empty(spark):
    path = scratch_path(spark, "guard-test")
    df = spark.range(5)
    assert load_if_empty(spark, df, path) is True
    assert load_if_empty(spark, df, path) is False
    assert spark.read.parquet(path).count() == 5
    # an existing but empty table is loaded (unlike mode("ignore"))
    empty = scratch_path(spark, "guard-empty")
    spark.range(0).write.parquet(empty)
    assert load_if_empty(spark, df, empty) is True


def test_extract_since_picks_up_new_rows(spark):
    root = scratch_path(spark, "extract-test")
    first = spark.range(1, 6).withColumnRenamed("id", "k")
    n1, m1 = flow.extract_since(spark, first, "k", f"{root}/t")
    grown = spark.range(1, 9).withColumnRenamed("id", "k")
    n2, m2 = flow.extract_since(spark, grown, "k", f"{root}/t")
    n3, m3 = flow.extract_since(spark, grown, "k", f"{root}/t")
    assert (n1, m1, n2, m2, n3, m3) == (5, 5, 3, 8, 0, 8)
    assert flow.extracted(spark, f"{root}/t").count() == 8


def test_extract_repeats_a_run_that_did_not_commit(spark):
    """A run folder without _SUCCESS (an interrupted write) is written again: nothing twice, nothing lost."""
    root = scratch_path(spark, "extract-test")
    rows = lambda n: spark.range(1, n).withColumnRenamed("id", "k")
    flow.extract_since(spark, rows(6), "k", f"{root}/t")
    flow.extract_since(spark, rows(9), "k", f"{root}/t")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/t/run=2/_SUCCESS")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
    assert flow.committed_runs(spark, f"{root}/t") == [1]
    assert flow.extract_since(spark, rows(11), "k", f"{root}/t") == (5, 10)
    assert sorted(r.k for r in flow.extracted(spark, f"{root}/t").collect()) == list(range(1, 11))


def test_validate_json_flags_missing_fields(spark):
    msgs = spark.createDataFrame(
        [('{"event_id":"1","request_ref":"R1","department":"D","priority":"HIGH",'
          '"timestamp":"2024-01-01T00:00:00"}',),
         ('{"event_id":"2","request_ref":"R2","priority":"LOW"}',),
         ("not json",)], "value string")
    got = [(r.valid, r.missing_fields) for r in flow.validate_json(msgs).collect()]
    assert got == [(1, ""), (0, "department,timestamp"),
                   (0, "event_id,request_ref,department,priority,timestamp")]


def test_conform_casts_and_fills(spark):
    df = spark.createDataFrame([("R1", "N1", "2024-01-02T03:04:05.5", "x")],
                               "request_ref string, department string, submitted_at string, "
                               "extra string")
    out = flow.conform(df, flow.REQUEST_STAGING, flow.EVENT_TO_STAGING).first()
    assert out.department_code == "N1" and out.channel is None
    assert str(out.submitted_at) == "2024-01-02 03:04:05.500000"
    assert "extra" not in out.asDict()


def test_sla_flag_matches_compliance(spark):
    from conftest import SF001
    from servstar.plans.warehouse import warehouse
    df = flow.sla_flag(warehouse(spark, SF001).service_requests)
    assert df.where(F.col("sla_flag") != F.col("sla_compliant")).count() == 0


def test_defaults_apply_only_to_absent_columns(spark):
    from servstar import schemas
    df = spark.createDataFrame([(1, "R1", None)], "request_id long, request_ref string, status string")
    row = schemas.conform(df, schemas.SERVICE_REQUESTS).first()
    assert row.status is None                 # explicit NULL stays NULL
    assert row.priority == "NORMAL" and row.sla_compliant == 0
    assert row.created_at is not None and row.completed_at is None


def test_seed_table_and_code_lookup(spark):
    from servstar.sources.tables import resolve_codes, seed_table
    depts = seed_table(spark, "departments", [(1, "DEPA", "Ministry of Health", "Health"),
                                              (2, "DEPB", "Ministry of Transport", None)])
    assert depts.columns[:4] == ["department_id", "department_code", "department_name",
                                 "department_sector"]
    svc = spark.createDataFrame([("S1", "DEPA"), ("S2", "DEPB"), ("S3", "NONE")],
                                "service_code string, department_code string")
    got = {r.service_code: r.department_id
           for r in resolve_codes(svc, depts, "department_code", "department_code",
                                  "department_id").collect()}
    assert got == {"S1": 1, "S2": 2, "S3": None}
    by_name = seed_table(spark, "sla_definitions",
                         [{"sla_id": 7, "service_type_id": 1, "priority_level": "HIGH",
                           "sla_hours": 24}])
    assert by_name.first().sla_hours == 24 and by_name.first().created_at is not None


def test_cli_writes_kpi_files(spark, tmp_path):
    """The kpis command writes the four result files with their headers."""
    from servstar.__main__ import KPI_FILES, main
    from conftest import SF0001
    out = str(tmp_path / "out")
    main(["kpis", "--tables", SF0001, "--out", out])
    import glob
    heads = {}
    for fname in KPI_FILES:
        part = glob.glob(f"{out}/{fname}/part-*.csv")
        assert len(part) == 1
        heads[fname] = open(part[0]).readline().strip()
    assert heads["kpi1_resolution.csv"] == ("department_name,department_sector,total_requests,"
                                            "avg_resolution_hours,min_resolution_hours,"
                                            "max_resolution_hours")
    assert heads["kpi4_monthly_trend.csv"] == ("year_num,month_num,month_name,quarter_name,"
                                               "total_requests,sla_compliance_pct,"
                                               "avg_satisfaction,avg_resolution_hours")


def test_load_twice_resumes_and_keeps_counts(spark):
    """A second load into the same root skips every committed step (IO6)."""
    import os
    from conftest import SF0001
    from servstar.plans.marts import row_counts
    from servstar.plans.warehouse import SOURCE_TABLES, STAR_TABLES, load
    from servstar.session import local_path
    root = scratch_path(spark, "reload")
    names = SOURCE_TABLES + STAR_TABLES
    first = load(spark, SF0001, root)
    counts1 = {r.table_name: r.row_count
               for r in row_counts({n: first.table(n) for n in names}).collect()}
    stamps = {n: os.path.getmtime(f"{local_path(root)}/{n}/_SUCCESS") for n in names}
    second = load(spark, SF0001, root)
    counts2 = {r.table_name: r.row_count
               for r in row_counts({n: second.table(n) for n in names}).collect()}
    assert counts1 == counts2 and counts1["fact_service_requests"] > 0
    assert {n: os.path.getmtime(f"{local_path(root)}/{n}/_SUCCESS") for n in names} == stamps
    assert second.sizes == first.sizes        # dimension sizes recovered by bounded reads


def test_two_key_profile_in_one_scan_matches_per_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (None, "c"), (3, None), (3, None)],
                               "k long, code string")
    both = {r.key_columns: tuple(r)[2:]
            for r in quality.table_key_profiles(df, "t", [["k"], ["code"]]).collect()}
    one = {key[0]: tuple(quality.key_profile(df, "t", key).first())[2:]
           for key in (["k"], ["code"])}
    assert both == one
    assert both["k"] == (6, 4, 1, 2, 4) and both["code"] == (6, 4, 2, 2, 4)
    plan = quality.table_key_profiles(df, "t", [["k"], ["code"]])._jdf.queryExecution() \
                  .executedPlan().toString()
    assert "Expand" in plan


def test_warehouse_lasts_between_applications(spark, monkeypatch):
    """Half of a load survives; a later application builds the rest, and a third builds nothing."""
    from servstar.plans import warehouse as w
    root = scratch_path(spark, "lasting")
    spark.conf.set(w.ROOT_SETTING, root)
    try:
        built = []
        real = w._write

        def failing(df, path, *a, **k):
            if path.endswith("/fact_service_requests"):
                raise RuntimeError("lost")
            built.append(path.rsplit("/", 1)[1])
            return real(df, path, *a, **k)

        monkeypatch.setattr(w, "_LOADED", {})
        monkeypatch.setattr(w, "_write", failing)
        with pytest.raises(RuntimeError, match="lost"):
            w.warehouse(spark, SF0001)
        first = set(built)
        assert "requests" in first and "fact_service_requests" not in first
        built.clear()
        monkeypatch.setattr(w, "_write", lambda df, path, *a, **k: (built.append(path.rsplit("/", 1)[1]), real(df, path, *a, **k))[1])
        assert w.warehouse(spark, SF0001).fact_service_requests.count() > 0
        assert "fact_service_requests" in built and not first & set(built)
        built.clear()
        monkeypatch.setattr(w, "_LOADED", {})
        assert w.warehouse(spark, SF0001).fact_service_requests.count() > 0
        assert built == []
        assert w.lasting_root(spark, SF0001) != w.lasting_root(spark, "/root/testdata/sf0.01")
    finally:
        spark.conf.unset(w.ROOT_SETTING)
    assert w.lasting_root(spark, SF0001) is None


def test_fingerprint_sees_partition_folders_and_rules(spark, tmp_path, monkeypatch):
    """A file added below a partition folder, or another rule, makes another warehouse folder."""
    from servstar.plans import warehouse as w
    orders = spark.range(10).selectExpr("id as o_orderkey", "id % 2 as part")
    orders.write.partitionBy("part").parquet(str(tmp_path / "orders.parquet"))
    first = w.input_fingerprint(spark, str(tmp_path))
    assert w.input_fingerprint(spark, str(tmp_path) + "/") == first
    orders.limit(1).drop("part").write.mode("append").parquet(str(tmp_path / "orders.parquet" / "part=1"))
    second = w.input_fingerprint(spark, str(tmp_path))
    monkeypatch.setattr(w, "rules_fingerprint", lambda: "other rules")
    assert len({first, second, w.input_fingerprint(spark, str(tmp_path))}) == 3
