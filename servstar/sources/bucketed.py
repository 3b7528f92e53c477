"""Request-sized tables stored in buckets of ``request_id``: joins and key checks on it shuffle nothing (J8, DQ2, DQ4).

A table is shuffled once, when it is written. Afterwards the survey join, the uniqueness check of either table and the
foreign key between them read matching buckets side by side. The catalog entry is only a
description of the files: an application that finds a committed folder describes it anew (``opened``), whatever catalog it has.

For keys that are meant to be unique. One that a large share of the rows bears would fill one bucket; profile untrusted
input first (``quality.key_profile`` over the plain table combines before it shuffles).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servstar.operators import fact, quality
from servstar.plans.warehouse import StoredWarehouse, warehouse
from servstar.sources.tables import path_exists

#: Rows that one bucket should hold at most; a bucket is read by one task.
BUCKET_ROWS = 4_000_000
LEAST_BUCKETS = 8
KEY = "request_id"
TABLES = ("service_requests", "user_surveys")


def buckets_for(rows: int) -> int:
    """The power of two, 8 at least, that keeps buckets of unique keys at about ``BUCKET_ROWS`` rows or fewer."""
    n = LEAST_BUCKETS
    while n * BUCKET_ROWS < rows:
        n *= 2
    return n


def _name(path: str) -> str:
    return "bucketed_" + hashlib.md5(path.encode()).hexdigest()[:16]


def opened(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> DataFrame:
    """The bucketed table whose files lie at ``path``; ``columns`` is its schema as DDL."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(path)} ({columns}) USING parquet "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(_name(path))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` stored at ``path`` in ``buckets`` files by ``key``, written unless a write there committed."""
    spark = df.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
        df.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", path) \
            .bucketBy(buckets, key).sortBy(key).saveAsTable(_name(path))
    return opened(spark, path, _ddl(df), key, buckets)


def request_tables(wh: StoredWarehouse) -> dict[str, DataFrame]:
    """Requests and surveys of the warehouse in equally many buckets of ``request_id`` (written on first use)."""
    n = buckets_for(wh.service_requests.count())
    return {t: bucketed(wh.table(t), f"{wh.root}/_bucketed/{t}-{n}", KEY, n) for t in TABLES}


# -- queries ---------------------------------------------------------------------
def fact_by_survey_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact by its declared join of requests and surveys, bucket by bucket."""
    wh = warehouse(spark, sf_dir)
    tables = request_tables(wh)
    return fact.build_fact(tables["service_requests"], tables["user_surveys"], wh.dim("dim_department"),
                           wh.dim("dim_service_type"), wh.dim("dim_sla"))


def key_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of ``request_id`` in both tables."""
    profiles = [quality.key_profile(df, t, [KEY]) for t, df in request_tables(warehouse(spark, sf_dir)).items()]
    return profiles[0].unionByName(profiles[1])


def requests_surveyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The foreign key between them, looked at from both sides: requests with and without a survey, surveys without a request."""
    tables = request_tables(warehouse(spark, sf_dir))
    r, s = tables["service_requests"].select(KEY), tables["user_surveys"].select(F.col(KEY).alias("surveyed"))
    both = r.join(s, F.col(KEY) == F.col("surveyed"), "full_outer")
    known, has = F.col(KEY).isNotNull(), F.col("surveyed").isNotNull()
    return both.agg(F.count_if(known & has).alias("surveyed"), F.count_if(known & ~has).alias("not_surveyed"),
                    F.count_if(~known).alias("surveys_without_request"))
