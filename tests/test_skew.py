"""Skew: one customer places a third of all orders and one order holds a third
of all lines. With broadcasts off (as for tables too large to broadcast), the
request build must still give whole, correct results; the line aggregate
collapses the hot order map-side, and AQE splits the hot customer's partition
of the sort-merge join."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from servstar.session import scratch_path
from servstar.sources import binding
from servstar.sources.tables import SourceTables

N_ORDERS = 30_000
HOT_ORDER_LINES = 20_000


@pytest.fixture(scope="module")
def skewed(spark):
    root = scratch_path(spark, "skewed")
    spark.range(1).select(F.lit(0).alias("r_regionkey"), F.lit("R").alias("r_name")) \
         .write.parquet(f"{root}/region.parquet")
    spark.range(5).select(F.col("id").cast("int").alias("n_nationkey"),
                          F.concat(F.lit("NATION_"), F.col("id")).alias("n_name"),
                          F.lit(0).alias("n_regionkey")).write.parquet(f"{root}/nation.parquet")
    spark.range(1, 1001).select(F.col("id").alias("c_custkey"),
                                F.concat(F.lit("C"), F.col("id")).alias("c_name"),
                                (F.col("id") % 5).cast("int").alias("c_nationkey"),
                                F.lit("BUILDING").alias("c_mktsegment")) \
         .write.parquet(f"{root}/customer.parquet")
    spark.range(1, 101).select(F.col("id").alias("p_partkey"),
                               F.when(F.col("id") % 2 == 0, "SMALL").otherwise("ECONOMY")
                               .alias("p_type")).write.parquet(f"{root}/part.parquet")
    # every third order belongs to customer 1
    spark.range(1, N_ORDERS + 1).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1000 + 1)
         .cast("long").alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.lit("1996-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("2-HIGH").alias("o_orderpriority")).repartition(8) \
        .write.parquet(f"{root}/orders.parquet")
    # one line per order, plus HOT_ORDER_LINES lines of order 7
    per_order = spark.range(1, N_ORDERS + 1).select(F.col("id").alias("l_orderkey"),
                                                    (F.col("id") % 100 + 1).alias("l_partkey"))
    hot = spark.range(HOT_ORDER_LINES).select(F.lit(7).cast("long").alias("l_orderkey"),
                                              (F.col("id") % 100 + 1).alias("l_partkey"))
    per_order.unionByName(hot).select(
        "l_orderkey", "l_partkey", F.lit(2.0).alias("l_quantity"),
        F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"),
        F.lit("R").alias("l_returnflag"),
        (F.lit("1996-01-01").cast("timestamp_ntz")
         + F.make_dt_interval(F.col("l_partkey") % 30)).alias("l_shipdate")) \
        .repartition(8).write.parquet(f"{root}/lineitem.parquet")
    return root


def test_skewed_request_build_is_whole_and_split(spark, skewed):
    ss = spark.newSession()
    ss.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    ss.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    ss.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    ss.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    ss.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ss.conf.set("spark.sql.shuffle.partitions", "16")
    src = SourceTables(ss, skewed)

    staging = binding.request_staging(src)
    rows = staging.agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.col("returned_lines")).alias("lines"),
                       F.count_if(F.col("department_id") == 1).alias("dept1"))
    r = rows.collect()[0]
    assert r.n == N_ORDERS
    assert r.lines == N_ORDERS + HOT_ORDER_LINES     # nothing dropped or capped
    hot = staging.where("request_id = 7").first()
    assert hot.returned_lines == HOT_ORDER_LINES + 1 and hot.completed_at is not None

    final = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in final and "skew=true" in final

    lines = binding.order_lines(src)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in plan and "partial_min" in plan  # map-side combine
