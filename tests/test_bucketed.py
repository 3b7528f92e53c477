"""Bucketed request tables: no shuffle by request_id in the survey join, the key check and the foreign key."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF0001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _unbroadcast(spark):
    ss = spark.newSession()
    ss.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return ss


def test_no_shuffle_by_request(spark):
    from servstar.sources import bucketed
    ss = _unbroadcast(spark)
    for query in (bucketed.fact_by_survey_join, bucketed.key_profiles, bucketed.requests_surveyed):
        plan = _plan(query(ss, SF0001))
        assert "hashpartitioning(request_id" not in plan and "hashpartitioning(surveyed" not in plan, query.__name__
    assert "SortMergeJoin" in _plan(bucketed.requests_surveyed(ss, SF0001))
    from servstar.registry import QUERIES
    assert "hashpartitioning(request_id" in _plan(QUERIES["fact_survey_join"](ss, SF0001))  # the plain tables do shuffle


def test_files_outlast_the_catalog_entry(spark, tmp_path):
    from servstar.sources import bucketed
    rows, at = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("decimal(5,1)").alias("v")), str(tmp_path / "t")
    first = bucketed.bucketed(rows, at, "k", 8)
    want = sorted(first.collect())
    assert want == sorted(rows.collect())
    spark.sql(f"DROP TABLE {bucketed._name(at)}")
    again = bucketed.bucketed(rows.limit(0), at, "k", 8)  # committed already: described, not written
    assert sorted(again.collect()) == want
    per_key = again.groupBy("k").count()
    assert "Exchange" not in _plan(per_key) and per_key.count() == 1000


def test_repeated_null_and_absent_keys(spark, tmp_path):
    from servstar.operators import quality
    from servstar.sources import bucketed
    rows = spark.createDataFrame([(None,), (None,), (1,), (1,), (1,), (2,)], "k long")
    table = bucketed.bucketed(rows, str(tmp_path / "t"), "k", 8)
    got = quality.key_profile(table, "t", ["k"]).first()
    assert (got.total_rows, got.distinct_keys, got.null_key_rows, got.duplicated_keys, got.duplicated_rows) == (6, 3, 2, 2, 5)
    none = bucketed.bucketed(rows.limit(0), str(tmp_path / "none"), "k", 8)
    assert none.count() == 0 and quality.key_profile(none, "t", ["k"]).first().total_rows == 0


def test_bucket_count_follows_the_rows():
    from servstar.sources.bucketed import BUCKET_ROWS, buckets_for
    assert [buckets_for(n) for n in (0, 8 * BUCKET_ROWS, 8 * BUCKET_ROWS + 1, 1000 * BUCKET_ROWS)] == [8, 8, 16, 1024]
