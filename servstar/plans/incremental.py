"""The five steps of the declared flow as one incremental load (N1-N5, IO5, IO6).

The source is a full snapshot as JSON messages. Each run

1. parses a message once and sets aside those that lack a required field (N2),
2. flags requests that met their deadline (N3) and casts them to the declared types (N4),
3. compares keys and row hashes with the stored table, so that only new, changed, late and removed rows count (N1),
4. rewrites the months that hold such rows, by dynamic partition overwrite, and no others (N5).

Only key, hash and month of the stored rows are read for the comparison. A run that fails half way is repeated:
what it had written already compares equal, the rest is written again. A repeat of a finished run writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servstar.plans.flow import conform, sla_met
from servstar.plans.warehouse import warehouse
from servstar.session import scratch_path
from servstar.sources.tables import delete, read_or_none, unsorted_writes

REQUIRED = ("request_id", "request_ref", "priority", "submitted_at")
TARGET = T.StructType([
    T.StructField("request_id", T.LongType(), False), T.StructField("request_ref", T.StringType(), False),
    T.StructField("department_id", T.LongType(), True), T.StructField("channel", T.StringType(), True),
    T.StructField("status", T.StringType(), True), T.StructField("priority", T.StringType(), True),
    T.StructField("submitted_at", T.TimestampNTZType(), True), T.StructField("sla_deadline", T.TimestampNTZType(), True),
    T.StructField("completed_at", T.TimestampNTZType(), True), T.StructField("sla_flag", T.IntegerType(), True)])
_SENT = [f.name for f in TARGET.fields if f.name != "sla_flag"]
_STORED = T.StructType([*TARGET.fields, T.StructField("row_hash", T.LongType()), T.StructField("month", T.StringType())])


def messages_of(requests: DataFrame) -> DataFrame:
    """One JSON ``value`` per request, all fields as text."""
    return requests.select(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in _SENT])).alias("value"))


def prepared(messages: DataFrame) -> DataFrame:
    """The target's columns, ``row_hash``, ``month`` and ``missing`` (required fields that a message lacks, or
    'unreadable'; NULL for a good one)."""
    record = F.from_json("value", T.StructType([T.StructField(c, T.StringType()) for c in _SENT]))
    fields = messages.select("value", record.alias("r")).select("value", "r.*")
    lacking = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    missing = F.when(F.coalesce(*_SENT).isNull(), F.lit("unreadable")).when(lacking != "", lacking)
    typed = conform(fields.withColumn("sla_flag", sla_met(F.to_timestamp_ntz("completed_at"), F.to_timestamp_ntz("sla_deadline"))
                                      .cast("int")).withColumn("missing", missing),
                    T.StructType([*TARGET.fields, T.StructField("missing", T.StringType())]))
    month = F.coalesce(F.date_format("submitted_at", "yyyy-MM"), F.lit("none"))
    return typed.withColumns({"row_hash": F.xxhash64(*[f.name for f in TARGET.fields]), "month": month})


def write_by_month(content: DataFrame, target: str) -> None:
    """Overwrites the months of ``content`` in the table at ``target``, and no others.

    A task has the rows of a few months, or a part of one month's: each month's file stays open, so that no task sorts its rows."""
    with unsorted_writes(content.sparkSession):
        content.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("month").parquet(target)


def upsert(rows: DataFrame, target: str, key: str, schema: T.StructType, complete: bool = True) -> dict:
    """Brings the table at ``target`` (partitioned by ``month``) to ``rows`` (unique on ``key``, with ``row_hash`` and ``month``), and
    returns how many rows were new, changed and removed, and how many months were written.

    ``complete``: the rows are all there are, so stored keys that they lack are removed; else those stay."""
    spark = rows.sparkSession
    stored = read_or_none(spark, target, schema)
    if stored is None:
        stored = spark.createDataFrame([], schema)
    had = stored.select(F.col(key).alias("had_key"), F.col("row_hash").alias("had_hash"), F.col("month").alias("had_month"))
    both = rows.select(key, "row_hash", "month").join(had, F.col(key) == F.col("had_key"), "full_outer" if complete else "left")
    kind = F.when(F.col("had_key").isNull(), "new_rows").when(F.col(key).isNull(), "removed_rows") \
        .when((F.col("row_hash") != F.col("had_hash")) | (F.col("month") != F.col("had_month")), "changed_rows")
    delta_path = scratch_path(spark, "delta")
    both.withColumn("kind", kind).filter("kind is not null").select(
        F.coalesce(key, "had_key").alias("delta_key"), "kind", "month", "had_month").write.parquet(delta_path)
    delta = spark.read.parquet(delta_path)
    counts = {r.kind: r["count"] for r in delta.groupBy("kind").count().collect()}
    months = sorted(r.m for r in delta.select(F.explode(F.array("month", "had_month")).alias("m")).filter("m is not null")
                    .distinct().collect())  # at most the calendar's months
    if months:
        inside = F.col("month").isin(*months)
        names = [f.name for f in schema.fields]
        if complete:  # a month then holds the rows that it was sent: neither stored rows nor the delta are joined
            content = rows.filter(inside & F.col(key).isNotNull()).select(names)
        else:
            changed = delta.select("delta_key")
            kept = stored.filter(inside).join(changed, F.col(key) == F.col("delta_key"), "left_anti")
            fresh = rows.filter(inside).join(changed, F.col(key) == F.col("delta_key"), "left_semi")
            content = kept.select(names).unionByName(fresh.select(names))
        filled = {r.month for r in content.select("month").distinct().collect()}
        write_by_month(content, target)
        # the overwrite leaves the folders of months that hold no row any more
        for m in months:
            if m not in filled:
                delete(spark, f"{target}/month={m}")
    return {"new_rows": 0, "changed_rows": 0, "removed_rows": 0} | counts | {"months_written": len(months)}


def load_requests(spark: SparkSession, messages: DataFrame, target: str, rejected: str) -> dict:
    """One run of the flow; bad messages replace those at ``rejected``. The counts of ``upsert``, ``rejected_rows`` and ``target_rows``."""
    path = scratch_path(spark, "prepared")
    prepared(messages).write.parquet(path)  # no partitions: those would have each task sort its rows
    rows = spark.read.schema(T.StructType([*_STORED.fields, T.StructField("missing", T.StringType())])).parquet(path)
    rows.filter("missing is not null").select("request_id", "missing").write.mode("overwrite").parquet(rejected)
    done = upsert(rows.filter("missing is null").drop("missing"), target, "request_id", _STORED)
    return done | {"rejected_rows": spark.read.parquet(rejected).count(),
                   "target_rows": spark.read.schema(_STORED).parquet(target).count()}


# -- two days of the given requests --------------------------------------------------------------
def _days(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The requests as they are (second day), and an earlier state: every seventh wasn't there yet, every eleventh
    had another channel, every thirteenth had a twin that is gone by now. Every seventeenth lacks its priority on both days."""
    k = F.col("request_id")
    now = requests.withColumn("priority", F.when(k % 17 != 0, F.col("priority")))
    old = now.filter(k % 7 != 0).withColumn("channel", F.when(k % 11 == 0, F.lit("OLD")).otherwise(F.col("channel")))
    gone = now.filter(k % 13 == 0).withColumns({"request_id": -k - 1, "request_ref": F.concat(F.col("request_ref"), F.lit("-T"))})
    return old.unionByName(gone), now


_DONE: dict = {}


def _two_days(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _DONE:
        root = scratch_path(spark, "incremental")
        first, second = _days(warehouse(spark, sf_dir).service_requests)
        _DONE[key] = (f"{root}/target", [load_requests(spark, messages_of(d), f"{root}/target", f"{root}/rejected")
                                         for d in (first, second, second)])
    return _DONE[key]


COUNTS = ("new_rows", "changed_rows", "removed_rows", "rejected_rows", "months_written", "target_rows")


def incremental_load(spark, sf_dir):
    """What three runs did: an earlier state, the present one, and that once more."""
    runs = _two_days(spark, sf_dir)[1]
    return spark.createDataFrame([(k + 1, *[r[c] for c in COUNTS]) for k, r in enumerate(runs)],
                                 "run int, " + ", ".join(f"{c} long" for c in COUNTS))


def incremental_load_rows(spark, sf_dir):
    """The table after them."""
    return spark.read.schema(_STORED).parquet(_two_days(spark, sf_dir)[0]).drop("row_hash", "month")
