"""Request events: JSON producer and the Structured Streaming consumer (ST1-ST8).

Producer (IO11, F28): the given ``events`` table is bound to the event record
(all fields strings) and serialised with ``to_json(struct(...))`` into a
``value`` column. It goes to Kafka when broker options are given, else to JSON
text files (one message per line) that a file stream reads the same way.

Consumer: one query that decodes each message once. Its batch function adds the
micro-batch's counts per (department, priority) to the newest committed snapshot of the
count table and keeps messages that do not decode, or lack department / priority, in a
quarantine table. The running per-department, per-priority and total counts of the
reference are sums over the cells, so three summaries cost one small table.
``availableNow`` drains what is there and stops (ST6); the checkpoint records progress
(ST7), so a restart adds nothing. Each micro-batch writes folders of its own, numbered by
the batch, from the snapshot before it: a batch replayed after a failure gives the same
folders, and readers take the newest committed one, never a half-written one.
"""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from servstar import schemas
from servstar.functions.expr import event_priority
from servstar.plans.warehouse import lasting_root
from servstar.session import scratch_path
from servstar.sources.tables import SourceTables, delete as _delete, folder_numbers, path_exists, rename

# Fixed values of the event record.
EVENT_TYPE = "SERVICE_REQUEST_CREATED"
EVENT_STATUS = "SUBMITTED"
KAFKA_TOPIC = "service-requests"   # default; pass topic= for another one

EVENT_FIELDS = [f.name for f in schemas.EVENT.fields]


def iso_text(ts) -> F.Column:
    """ISO-8601 text of a timestamp, fraction only when non-zero (as Python's
    ``isoformat``)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    # The text of a zone-less timestamp: no session time zone takes part.
    text = ts.cast("timestamp_ntz").cast("string")
    whole, frac = F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit("T")), F.substring(text, 21, 6)
    return F.when(frac == "", whole).otherwise(F.concat(whole, F.lit("."), F.rpad(frac, 6, "0")))


def event_records(events: DataFrame) -> DataFrame:
    """The given ``events`` rows as event records (strings, as produced)."""
    k = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        iso_text("ts").alias("timestamp"),
        F.concat(F.lit("EVT-"), F.col("event_id").cast("string")).alias("request_ref"),
        F.col("event_type").alias("department"),
        F.concat(F.lit("SVC-"), F.col("user_id").cast("string")).alias("service_type"),
        F.lit("events").alias("channel"),
        event_priority(k).alias("priority"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("requester_name"),
        F.lit(None).cast("string").alias("requester_email"),
        F.lit(EVENT_STATUS).alias("status"),
    )


def encode(records: DataFrame) -> DataFrame:
    """One JSON ``value`` per record, keyed by request_ref (Kafka key)."""
    return records.select(F.col("request_ref").alias("key"),
                          F.to_json(F.struct(*EVENT_FIELDS)).alias("value"))


def decode(messages: DataFrame) -> DataFrame:
    """``value`` (string or bytes) -> event columns plus ``_ok`` (decodable and
    carrying department and priority) and the raw text."""
    raw = F.col("value").cast("string")
    ev = F.from_json(raw, schemas.EVENT)
    ok = ev.isNotNull() & ev["department"].isNotNull() & ev["priority"].isNotNull()
    return messages.select(raw.alias("raw"), ev.alias("ev"), ok.alias("_ok")) \
                   .select("raw", "_ok", "ev.*")


def produce(messages: DataFrame, path: str | None = None,
            kafka_options: dict | None = None, topic: str = KAFKA_TOPIC) -> None:
    """Publish encoded messages: Kafka when ``kafka_options`` (with
    ``kafka.bootstrap.servers``) is given, else JSON-lines files at ``path``."""
    if kafka_options:
        w = messages.write.format("kafka").option("topic", topic)
        for k, v in kafka_options.items():
            w = w.option(k, v)
        w.save()
    else:  # a message log only grows: new files next to the old ones
        messages.select("value").write.mode("append").text(path)


def publish_once(messages: DataFrame, path: str, publish_id: str) -> bool:
    """Adds the messages to the file log at ``path`` as a whole and once: False if that publish is there already.

    They are written to a hidden folder first, which readers skip; renaming it to ``publish=<id>`` is what publishes
    them, and the log's folders of that name are its manifest. A publish that fails half way leaves nothing that a reader sees and is
    repeated under the same id. The store must rename a folder in one step (HDFS, local disks; plain object stores don't)."""
    spark = messages.sparkSession
    done = f"{path}/publish={publish_id}"
    if path_exists(spark, done):
        return False
    staged = f"{path}/_staged/{publish_id}-{uuid.uuid4().hex}"
    messages.select("value").write.text(staged)
    if not rename(spark, staged, done):
        _delete(spark, staged)
        if not path_exists(spark, done):
            raise OSError(f"cannot rename {staged} to {done}")
        return False  # another publisher was first
    return True


def message_stream(spark: SparkSession, path: str | None = None,
                   kafka_options: dict | None = None,
                   files_per_trigger: int | None = None,
                   topic: str = KAFKA_TOPIC) -> DataFrame:
    """Streaming DataFrame of raw messages (``value``) from the earliest offset."""
    if kafka_options:
        r = (spark.readStream.format("kafka").option("subscribe", topic)
             .option("startingOffsets", "earliest"))
        for k, v in kafka_options.items():
            r = r.option(k, v)
        return r.load().select(F.col("value").cast("string").alias("value"))
    r = spark.readStream.format("text")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(path)


def projection(decoded: DataFrame) -> DataFrame:
    """ST2: the per-event line (request_ref, department, service_type, priority)
    plus the parsed event time (F29)."""
    return decoded.where("_ok").select(
        "request_ref", "department", "service_type", "priority",
        F.to_timestamp_ntz("timestamp").alias("event_time"))


def cell_counts(decoded: DataFrame) -> DataFrame:
    """ST3-ST5 in one aggregate keyed by (department, priority)."""
    return decoded.where("_ok").groupBy("department", "priority") \
                  .agg(F.count(F.lit(1)).alias("events"))


def _counts_to(path: str, quarantine: str | None = None, keep: int = 2):
    """foreachBatch writer of the running counts and the quarantine (module docstring);
    snapshots beyond ``keep`` are removed after the new one commits."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # two writers, one read and one parse: of a good message only the two counted fields are held, of a bad one its text
        good = F.col("_ok")
        batch = batch.select("_ok", *[F.when(good, F.col(c)).alias(c) for c in ("department", "priority")],
                             F.when(~good, F.col("raw")).alias("raw")).persist()
        try:
            counts = cell_counts(batch)
            before = [n for n in _snapshots(spark, path) if n < batch_id]
            if before:
                kept = spark.read.schema(counts.schema).parquet(f"{path}/batch_id={before[-1]}")
                counts = counts.unionByName(kept).groupBy("department", "priority").agg(F.sum("events").alias("events"))
            counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            bad = batch.where(~F.col("_ok")).select("raw")
            if quarantine and not bad.isEmpty():
                bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        finally:
            batch.unpersist()
        for old in _snapshots(spark, path)[:-keep]:
            _delete(spark, f"{path}/batch_id={old}")
    return write


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    """Committed snapshot batch ids under ``path``, ascending."""
    return folder_numbers(spark, path, "batch_id=")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed snapshot of the count table."""
    ids = _snapshots(spark, path)
    if not ids:
        raise FileNotFoundError(f"no committed snapshot under {path}")
    return spark.read.parquet(f"{path}/batch_id={ids[-1]}")


def start_counts(spark: SparkSession, source: DataFrame, sink: str, checkpoint: str,
                 quarantine: str | None = None):
    """Start draining the stream into the cell-count table (and quarantine)."""
    return [decode(source).writeStream.foreachBatch(_counts_to(sink, quarantine))
            .option("checkpointLocation", f"{checkpoint}/counts").trigger(availableNow=True).start()]


# -- the same counts kept in Spark's state store (ST3-ST5), and a consumer that goes on until idle (ST6) -----
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Batches whose updates are kept apart before they are written together.
UPDATES_KEPT = 20
#: Fixed value: seconds without messages after which the reference's consumer ends.
IDLE_SECONDS = 8.0


def state_session(spark: SparkSession) -> SparkSession:
    """Child session whose stateful queries keep their rows in RocksDB, on the executors' disks and in the checkpoint."""
    ss = stream_session(spark)
    ss.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return ss


def start_state_counts(source: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None):
    """Counts per (department, priority) as a stateful aggregation in update mode: the state holds one row per
    key pair, a batch emits the pairs that it changed. ``source`` belongs to a ``state_session``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        older = [n for n in _snapshots(spark, sink) if n < batch_id]
        if len(older) >= UPDATES_KEPT:
            kept = spark.read.schema(batch.schema).parquet(*[f"{sink}/batch_id={n}" for n in older])
            batch = batch.unionByName(kept).groupBy("department", "priority").agg(F.max("events").alias("events"))
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        if len(older) >= UPDATES_KEPT:
            for n in older:
                _delete(spark, f"{sink}/batch_id={n}")

    return (cell_counts(decode(source)).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def read_state_counts(spark: SparkSession, sink: str) -> DataFrame:
    """The newest count of each key pair: counts only grow, so a batch written again, or read twice, changes nothing."""
    return spark.read.schema("department string, priority string, events long").parquet(
        *[f"{sink}/batch_id={n}" for n in _snapshots(spark, sink)]).groupBy("department", "priority").agg(F.max("events").alias("events"))


class IdleWatch(StreamingQueryListener):
    """When a query last took in messages."""

    def __init__(self):
        self.last: dict[str, float] = {}

    def onQueryStarted(self, event):
        self.last[str(event.id)] = time.monotonic()

    def onQueryProgress(self, event):
        if event.progress.numInputRows:
            self.last[str(event.progress.id)] = time.monotonic()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def run_until_idle(spark: SparkSession, start, seconds: float = IDLE_SECONDS) -> None:
    """Runs the query that ``start()`` starts until it took in nothing for ``seconds``, then stops it between batches."""
    watch = IdleWatch()
    spark.streams.addListener(watch)
    try:
        query = start()
        begun = time.monotonic()
        while query.isActive:
            query.awaitTermination(0.2)
            status = query.status
            if (time.monotonic() - watch.last.get(query.id, begun) > seconds
                    and not status["isTriggerActive"] and not status["isDataAvailable"]):
                query.stop()
        if query.exception() is not None:
            raise query.exception()
    finally:
        spark.streams.removeListener(watch)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Messages that do not decode, or lack department / priority, kept raw (none: no rows)."""
    if not folder_numbers(spark, path, "batch_id="):
        return spark.createDataFrame([], "raw string")
    return spark.read.schema("raw string, batch_id long").parquet(path).select("raw")


def start_projection(spark: SparkSession, source: DataFrame, sink: str, checkpoint: str):
    return (projection(decode(source)).writeStream.format("parquet").outputMode("append")
            .option("path", sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def await_all(queries) -> None:
    """Wait for every query; re-raise the first failure."""
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


# Shuffle partitions of the count query: its rows are one per (department, priority) and task,
# so it is sized to the keys rather than to the cluster-wide shuffle setting. A department holding
# a large share of events is combined per task before the shuffle.
STATE_PARTITIONS = 8
# Files per micro-batch: bounds the size of one batch when a large backlog is
# drained (tests use 1 to force many batches).
FILES_PER_TRIGGER = 64


def stream_session(spark: SparkSession) -> SparkSession:
    """Child session (same cluster) whose shuffle width is STATE_PARTITIONS."""
    ss = spark.newSession()
    ss.conf.set("spark.sql.shuffle.partitions", str(STATE_PARTITIONS))
    return ss


# -- summaries over the sink (ST8, O7) -------------------------------------------
def by_department(counts: DataFrame) -> DataFrame:
    return counts.groupBy("department").agg(F.sum("events").cast("long").alias("events")) \
                 .orderBy("department")


def by_priority(counts: DataFrame) -> DataFrame:
    return counts.groupBy("priority").agg(F.sum("events").cast("long").alias("events")) \
                 .orderBy("priority")


def total(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("events"), F.lit(0)).cast("long").alias("total_events"))


# -- one run per application and input folder ----------------------------------------
_RUNS: dict = {}
_LOCK = threading.Lock()


class StreamRun:
    """Messages produced from ``events`` of one folder, and the consumer sinks.

    The messages are published once; each consumer (counts with the quarantine of unreadable
    messages; the per-event projection) is drained on first use. With ``spark.servstar.root``
    set, messages, sinks and checkpoints last there: a later application goes on after the last
    committed batch. ``spoil`` changes the messages before they are published."""

    def __init__(self, spark: SparkSession, sf_dir: str, spoil=None):
        self.spark = spark
        kind = "stream" if spoil is None else f"stream-{spoil.__name__}"
        root = lasting_root(spark, sf_dir, kind) or scratch_path(spark, kind)
        self.messages = f"{root}/messages"
        self.counts = f"{root}/counts"
        self.quarantine = f"{root}/quarantine"
        self.projected = f"{root}/projection"
        self.checkpoint = f"{root}/_checkpoints"
        if not path_exists(spark, f"{self.messages}/_SUCCESS"):
            _delete(spark, self.messages)  # what an interrupted application left
            messages = encode(event_records(SourceTables(spark, sf_dir).table("events")))
            produce(spoil(messages) if spoil else messages, self.messages)
        self._done: set[str] = set()
        self._lock = threading.Lock()

    def _source(self, ss: SparkSession) -> DataFrame:
        return message_stream(ss, self.messages, files_per_trigger=FILES_PER_TRIGGER)

    def _drain(self, which: str) -> None:
        with self._lock:
            if which in self._done:
                return
            ss = stream_session(self.spark)
            if which == "counts":
                queries = start_counts(ss, self._source(ss), self.counts, self.checkpoint, self.quarantine)
            else:
                queries = [start_projection(ss, self._source(ss), self.projected,
                                            f"{self.checkpoint}/projection")]
            await_all(queries)
            self._done.add(which)

    def table(self, which: str, spark: SparkSession | None = None) -> DataFrame:
        """A sink, read through ``spark`` (its own session by default)."""
        spark = spark or self.spark
        self._drain("projected" if which == "projected" else "counts")
        if which == "counts":
            return read_counts(spark, self.counts)
        if which == "quarantine":
            return read_quarantine(spark, self.quarantine)
        return spark.read.parquet(self.projected)


def stream_run(spark: SparkSession, sf_dir: str, spoil=None) -> StreamRun:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), spoil)
    with _LOCK:
        run = _RUNS.get(key)
        if run is None:
            run = StreamRun(spark, sf_dir, spoil)
            _RUNS[key] = run
        return run


def _table(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """A sink of the folder's stream run, read through the calling session."""
    return stream_run(spark, sf_dir).table(which, spark)


# -- registry adapters ---------------------------------------------------------------
def stream_state_counts(spark, sf_dir):
    """The folder's messages in two halves, each published twice under its id: the first drained, then, from the same
    checkpoint and state, the second."""
    root = scratch_path(spark, "state-stream")
    messages = encode(event_records(SourceTables(spark, sf_dir).table("events")))
    half = F.pmod(F.xxhash64("key"), F.lit(2))
    ss = state_session(spark)
    for k in (0, 1):
        for _ in range(2):
            publish_once(messages.filter(half == k), f"{root}/messages", f"half-{k}")
        await_all([start_state_counts(message_stream(ss, f"{root}/messages", files_per_trigger=FILES_PER_TRIGGER),
                                      f"{root}/counts", f"{root}/checkpoint")])
    return read_state_counts(spark, f"{root}/counts")


def stream_by_department(spark, sf_dir):
    return by_department(_table(spark, sf_dir, "counts"))


def stream_by_priority(spark, sf_dir):
    return by_priority(_table(spark, sf_dir, "counts"))


def stream_total(spark, sf_dir):
    return total(_table(spark, sf_dir, "counts"))


def stream_projection(spark, sf_dir):
    df = _table(spark, sf_dir, "projected")
    return df.select("request_ref", "department", "service_type", "priority",
                     F.col("event_time").cast("timestamp_ntz").alias("event_time"))


def json_roundtrip(spark, sf_dir):
    """Encode the event records to JSON and decode them again (batch)."""
    events = SourceTables(spark, sf_dir).table("events")
    dec = decode(encode(event_records(events)))
    return dec.select(*[c for c in EVENT_FIELDS if c != "timestamp"],
                      F.to_timestamp_ntz("timestamp").alias("event_time"),
                      F.col("_ok").cast("int").alias("decoded_ok"))
