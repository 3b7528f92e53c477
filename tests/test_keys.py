"""Surrogate keys: kept over reloads, numbered in parallel."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF0001
from servstar.operators.keys import KeyMap
from servstar.plans.warehouse import load
from servstar.session import scratch_path


def test_first_run_numbers_in_order_and_later_runs_add(spark):
    keys = KeyMap(spark, scratch_path(spark, "keys"), "k", "name")
    as_rows = lambda *names: spark.createDataFrame([(n,) for n in names], "name string")
    assert {r.name: r.k for r in keys.extend(as_rows("m", "c", "x", "c")).collect()} == {"c": 1, "m": 2, "x": 3}
    got = {r.name: r.k for r in keys.keyed(as_rows("a", "x", None, "b")).collect()}
    assert got == {None: 4, "a": 5, "b": 6, "x": 3}
    assert {r.name: r.k for r in keys.extend(as_rows("m", None)).collect()} == {"c": 1, "m": 2, "x": 3, None: 4, "a": 5, "b": 6}
    assert keys.read().count() == 6


def test_a_million_keys_without_a_single_task_window(spark):
    keys = KeyMap(spark, scratch_path(spark, "keys"), "k", "n")
    first = spark.range(0, 2_000_000, 2).select((F.col("id") * 7919 % 2_000_000).alias("n"))
    known = keys.extend(first)
    assert known.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first() == (1, 1_000_000, 1_000_000)
    assert known.filter("k <> n div 2 + 1").count() == 0  # ascending with the natural key
    more = keys.extend(spark.range(0, 1000).select(F.col("id").alias("n")))
    assert more.agg(F.max("k"), F.count_distinct("k")).first() == (1_000_500, 1_000_500)
    assert more.join(known.withColumnRenamed("k", "old"), "n").filter("k <> old").count() == 0
    plan = keys.keyed(first)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_reload_with_one_more_part_type_keeps_every_key(spark, tmp_path):
    """Part types, departments and SLAs keep ids and keys when a type appears that sorts before all others."""
    keys = scratch_path(spark, "lasting-keys")
    before = load(spark, SF0001, keys_root=keys)
    tables = "region nation customer supplier part orders lineitem events".split()
    for t in tables:
        df = spark.read.parquet(f"{SF0001}/{t}.parquet")
        if t == "part":
            df = df.withColumn("p_type", F.when(F.col("p_partkey") % 5 == 0, "AAA FIRST").otherwise(F.col("p_type")))
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
    after = load(spark, str(tmp_path), keys_root=keys)
    for table, natural, key in (("service_catalog", "service_code", "service_type_id"), ("dim_service_type", "service_code", "service_key"),
                                ("dim_department", "department_id", "dept_key"), ("dim_sla", "sla_id", "sla_key")):
        old = {r[0]: r[1] for r in before.table(table).select(natural, key).collect()}
        new = {r[0]: r[1] for r in after.table(table).select(natural, key).collect()}
        assert all(new[n] == k for n, k in old.items() if n in new) and len(set(new.values())) == len(new), table
        if table == "service_catalog":
            assert new["AAA FIRST"] == max(old.values()) + 1
    assert {r.fact_id for r in after.fact_service_requests.select("fact_id").collect()}
