"""The declared extract -> validate -> flag -> convert -> load flow (N1-N5).

The reference names these five steps without defining them; the semantics here
are ours:

* N1 ``extract_since``   — incremental extract on a monotonically growing key:
  rows above the last extracted maximum, which is read from the committed
  runs of the target.
* N2 ``validate_json``   — pull fields out of JSON text with
  ``get_json_object`` and flag records that miss a required field.
* N3 ``sla_flag``        — 1 when the request was completed by its deadline.
* N4 ``conform``         — cast and rename to a declared ``StructType``.
* N5 load                — append (``sources.tables.append_table``); the
  extract appends one partition per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servstar.plans.warehouse import warehouse
from servstar.session import scratch_path
from servstar.sources.tables import SourceTables, folder_numbers
from servstar.streaming.events import encode, event_records


# -- N1 -----------------------------------------------------------------------------
def committed_runs(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the runs whose write committed."""
    return folder_numbers(spark, target, "run=")


def extract_since(spark: SparkSession, source: DataFrame, key: str, target: str) -> tuple[int, object]:
    """Append rows of ``source`` with ``key`` above the extracted maximum to
    ``target``; returns (rows appended, maximum after the run).

    Each run writes one partition ``run=<n>`` of ``target`` in a single pass;
    the row count and new maximum are observed during that write. Progress is
    read from the committed runs themselves, so there is no state that can be
    lost or run ahead: a run that fails is retried under the same number and
    overwrites its own partition. Rows that arrive late with a smaller key are
    not extracted; the key must grow monotonically.
    """
    runs = committed_runs(spark, target)
    last = None
    for n in reversed(runs):  # keys grow from run to run, so the last run that has rows has the maximum
        last = spark.read.schema(source.schema).parquet(f"{target}/run={n}").agg(F.max(key)).first()[0]
        if last is not None:
            break
    batch = source if last is None else source.where(F.col(key) > F.lit(last))
    obs = Observation("extract")
    batch = batch.observe(obs, F.count(F.lit(1)).alias("n"), F.max(key).alias("max_key"))
    batch.write.mode("overwrite").parquet(f"{target}/run={runs[-1] + 1 if runs else 1}")
    n, new_max = obs.get["n"], obs.get["max_key"]
    return n, (new_max if n else last)


def extracted(spark: SparkSession, target: str) -> DataFrame:
    """Everything extracted so far (all runs)."""
    return spark.read.parquet(target)


def incremental_extract(spark, sf_dir):
    """Two extract runs over the request table: the first takes every row, the
    second finds nothing above the stored maximum."""
    requests = warehouse(spark, sf_dir).service_requests
    root = scratch_path(spark, "extract")
    runs = []
    for run in (1, 2):
        n, mx = extract_since(spark, requests, "request_id", f"{root}/target")
        runs.append((run, int(n), mx))
    data = extracted(spark, f"{root}/target")
    total = data.agg(F.count(F.lit(1)).alias("target_rows"))
    out = None
    for run, n, mx in runs:
        row = total.select(F.lit(run).alias("run"), F.lit(n).cast("long").alias("extracted_rows"),
                           F.lit(mx).cast("long").alias("max_key"), "target_rows")
        out = row if out is None else out.unionByName(row)
    return out


# -- N2 -----------------------------------------------------------------------------
REQUIRED_FIELDS = ("event_id", "request_ref", "department", "priority", "timestamp")


def validate_json(messages: DataFrame, fields=REQUIRED_FIELDS, column: str = "value") -> DataFrame:
    """One column per JSON path ``$.<field>`` plus ``valid`` and the list of
    missing fields."""
    raw = F.col(column).cast("string")
    cols = [F.get_json_object(raw, f"$.{f}").alias(f) for f in fields]
    df = messages.select(*cols)
    missing = F.filter(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]),
                       lambda x: x.isNotNull())
    return df.select("*", F.array_join(missing, ",").alias("missing_fields"),
                     (F.size(missing) == 0).cast("int").alias("valid"))


def variant_fields(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """``df`` plus, per field (name to type), ``<name>`` and ``<name>_state``, from one parse of the JSON text: 'ok',
    'unreadable' (the text is no JSON), 'missing' (no such path, or JSON null) or 'wrong type'. NULL text has missing fields."""
    wide = df.withColumn("_variant", F.try_parse_json(column))
    out = {}
    for name, kind in fields.items():
        raw, typed = F.try_variant_get("_variant", f"$.{name}", "variant"), F.try_variant_get("_variant", f"$.{name}", kind)
        absent = raw.isNull() | F.is_variant_null(raw)
        out[name] = typed
        out[f"{name}_state"] = F.when(F.col("_variant").isNull() & F.col(column).isNotNull(), F.lit("unreadable")) \
            .when(absent, F.lit("missing")).when(typed.isNull(), F.lit("wrong type")).otherwise(F.lit("ok"))
    return wide.withColumns(out).drop("_variant")


def json_variant_fields(spark, sf_dir):
    """The events' ``k``, with the texts of some event types spoilt: cut short, renamed or no number."""
    kind = F.col("event_type")
    spoilt = F.when(kind == "error", F.substring("props", 1, 5)).when(kind == "view", F.replace("props", F.lit('"k"'), F.lit('"j"'))) \
        .when(kind == "signup", F.regexp_replace("props", r"(\d+)", '"n$1"')).when(kind == "click", F.regexp_replace("props", r"\d+", "null")) \
        .otherwise(F.col("props"))
    events = SourceTables(spark, sf_dir).table("events", "event_id", "event_type", "props").withColumn("props", spoilt)
    return variant_fields(events, "props", {"k": "long"}).select("event_id", "k", "k_state")


def json_path_validate(spark, sf_dir):
    events = SourceTables(spark, sf_dir).table("events")
    return validate_json(encode(event_records(events)))


# -- N3 -----------------------------------------------------------------------------
def sla_met(completed_at, sla_deadline):
    return F.coalesce(completed_at <= sla_deadline, F.lit(False))


def sla_flag(requests: DataFrame) -> DataFrame:
    """Deadline flag: completed at or before ``sla_deadline`` -> 1, else 0
    (an open request is 0)."""
    met = sla_met(F.col("completed_at"), F.col("sla_deadline"))
    return requests.select("request_id", "submitted_at", "sla_deadline", "completed_at",
                           met.cast("int").alias("sla_flag"),
                           F.col("sla_compliant"))


def sla_flag_q(spark, sf_dir):
    return sla_flag(warehouse(spark, sf_dir).service_requests)


# -- N4 -----------------------------------------------------------------------------
REQUEST_STAGING = T.StructType([
    T.StructField("request_ref", T.StringType(), False),
    T.StructField("department_code", T.StringType(), True),
    T.StructField("service_name", T.StringType(), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("priority", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("requester_name", T.StringType(), True),
    T.StructField("requester_email", T.StringType(), True),
    T.StructField("submitted_at", T.TimestampNTZType(), True),
])

EVENT_TO_STAGING = {"department": "department_code", "service_type": "service_name"}


def conform(df: DataFrame, schema: T.StructType, renames: dict | None = None) -> DataFrame:
    """Rename, then cast each declared field (``try_cast``: a value that does not
    convert becomes NULL rather than failing the job); absent fields are NULL."""
    renames = renames or {}
    src = {renames.get(c, c): c for c in df.columns}
    cols = []
    for f in schema.fields:
        if f.name in src:
            c = F.col(src[f.name])
            if f.dataType == T.TimestampNTZType():
                c = F.to_timestamp_ntz(c.cast("string"))
            else:
                c = c.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def conform_schema(spark, sf_dir):
    events = SourceTables(spark, sf_dir).table("events")
    recs = event_records(events).withColumnRenamed("timestamp", "submitted_at")
    return conform(recs, REQUEST_STAGING, EVENT_TO_STAGING)
