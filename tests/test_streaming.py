"""Streaming: many micro-batches equal one batch count; a restart from the
checkpoint adds nothing; undecodable messages go to quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF0001
from servstar.session import scratch_path
from servstar.sources.tables import SourceTables
from servstar.streaming import events as ev


def _produce(spark, n_files):
    recs = ev.event_records(SourceTables(spark, SF0001).table("events"))
    path = scratch_path(spark, "msgs")
    ev.produce(ev.encode(recs).repartition(n_files), path)
    return recs, path


def _drain(spark, path, sink, ckpt, per_trigger, quarantine=None):
    src = ev.message_stream(spark, path, files_per_trigger=per_trigger)
    qs = ev.start_counts(spark, src, sink, ckpt, quarantine)
    ev.await_all(qs)
    return qs


def test_batches_equal_batch_count_and_restart_adds_nothing(spark):
    recs, path = _produce(spark, 6)
    root = scratch_path(spark, "stream-test")
    qs = _drain(spark, path, f"{root}/counts", f"{root}/ckpt", per_trigger=1)
    assert len(qs[0].recentProgress) >= 6           # one file per micro-batch
    assert len(ev._snapshots(spark, f"{root}/counts")) <= 2   # old snapshots removed
    got = {(r.department, r.priority): r.events
           for r in ev.read_counts(spark, f"{root}/counts").collect()}
    want = {(r.department, r.priority): r["count"]
            for r in recs.groupBy("department", "priority").count().collect()}
    assert got == want
    # restart: nothing new, same table
    _drain(spark, path, f"{root}/counts", f"{root}/ckpt", per_trigger=1)
    again = {(r.department, r.priority): r.events
             for r in ev.read_counts(spark, f"{root}/counts").collect()}
    assert again == want
    tot = ev.total(ev.read_counts(spark, f"{root}/counts")).first().total_events
    assert tot == recs.count()


def test_bad_messages_go_to_quarantine(spark):
    path = scratch_path(spark, "msgs-bad")
    good = ('{"event_id":"1","request_ref":"R1","department":"D1","priority":"HIGH",'
            '"timestamp":"2024-01-01T00:00:00.250"}')
    spark.createDataFrame([(good,), ("{broken",), ('{"event_id":"3"}',)], "value string") \
         .coalesce(1).write.text(path)
    root = scratch_path(spark, "stream-bad")
    _drain(spark, path, f"{root}/counts", f"{root}/ckpt", per_trigger=None,
           quarantine=f"{root}/quarantine")
    counts = ev.read_counts(spark, f"{root}/counts").collect()
    assert [(r.department, r.priority, r.events) for r in counts] == [("D1", "HIGH", 1)]
    bad = sorted(r.raw for r in spark.read.parquet(f"{root}/quarantine").collect())
    assert bad == ['{"event_id":"3"}', "{broken"]


def test_iso_text_and_parse_roundtrip(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00' AS a, "
                   "TIMESTAMP_NTZ'2024-01-01 10:00:00.123456' AS b")
    row = df.select(ev.iso_text("a").alias("a"), ev.iso_text("b").alias("b")).first()
    assert (row.a, row.b) == ("2024-01-01T10:00:00", "2024-01-01T10:00:00.123456")
    back = spark.createDataFrame([(row.a,), (row.b,)], "t string") \
                .select(F.to_timestamp("t").cast("timestamp_ntz").alias("t")).collect()
    assert [str(r.t) for r in back] == ["2024-01-01 10:00:00", "2024-01-01 10:00:00.123456"]


def test_new_messages_after_restart_are_counted_once(spark):
    recs = ev.event_records(SourceTables(spark, SF0001).table("events"))
    first = recs.where(F.col("event_id").cast("long") % 2 == 0)
    second = recs.where(F.col("event_id").cast("long") % 2 == 1)
    path = scratch_path(spark, "msgs-grow")
    root = scratch_path(spark, "stream-grow")
    ev.produce(ev.encode(first).repartition(3), path)
    _drain(spark, path, f"{root}/counts", f"{root}/ckpt", per_trigger=1)
    mid = ev.total(ev.read_counts(spark, f"{root}/counts")).first().total_events
    assert mid == first.count()
    ev.produce(ev.encode(second).repartition(3), path)      # more messages arrive
    _drain(spark, path, f"{root}/counts", f"{root}/ckpt", per_trigger=1)
    end = ev.total(ev.read_counts(spark, f"{root}/counts")).first().total_events
    assert end == recs.count()
    got = {r.department: r.events for r in ev.by_department(
        ev.read_counts(spark, f"{root}/counts")).collect()}
    want = {r.department: r["count"] for r in recs.groupBy("department").count().collect()}
    assert got == want


def test_summaries_quarantine_what_they_cannot_read(spark, tmp_path):
    """The consumer behind the summaries keeps undecodable and incomplete messages."""
    folder = str(tmp_path)
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(f"{folder}/events.parquet")
    run = ev.StreamRun(spark, folder)
    bad = ["not json", '{"priority": "LOW"}']
    spark.createDataFrame([(b,) for b in bad], "value string").write.mode("append").text(run.messages)
    good = spark.read.parquet(f"{folder}/events.parquet").count()
    assert ev.total(run.table("counts")).first()[0] == good
    assert sorted(r.raw for r in run.table("quarantine").collect()) == sorted(bad)


def test_stream_goes_on_in_a_later_application(spark, monkeypatch):
    """With a lasting root, a second run publishes nothing and counts nothing twice."""
    from servstar.plans.warehouse import ROOT_SETTING
    spark.conf.set(ROOT_SETTING, scratch_path(spark, "lasting-stream"))
    try:
        first = ev.StreamRun(spark, SF0001)
        n = ev.total(first.table("counts")).first()[0]
        batches = ev._snapshots(spark, first.counts)
        monkeypatch.setattr(ev, "produce", None)
        second = ev.StreamRun(spark, SF0001)
        assert ev.total(second.table("counts")).first()[0] == n > 0
        assert second.counts == first.counts and ev._snapshots(spark, second.counts) == batches
    finally:
        spark.conf.unset(ROOT_SETTING)


def test_a_replayed_batch_changes_nothing(spark):
    good = [('{"event_id":"%d","request_ref":"R","department":"D","priority":"LOW"}' % k,) for k in range(5)]
    batches = [ev.decode(spark.createDataFrame(rows, "value string")) for rows in (good, [*good, ("bad",)])]
    root = scratch_path(spark, "replayed")
    write = ev._counts_to(f"{root}/counts", f"{root}/quarantine")
    for k in (0, 1, 1):
        write(batches[k], k)
        assert ev.read_counts(spark, f"{root}/counts").first().events == 5 * (k + 1)
    assert [r.raw for r in ev.read_quarantine(spark, f"{root}/quarantine").collect()] == ["bad"]


def test_a_batch_holds_no_text_of_good_messages(spark, monkeypatch):
    """What a micro-batch keeps between its two writers: the counted fields, and the text of bad messages only."""
    kind = type(spark.range(1))
    held, persist = [], kind.persist
    monkeypatch.setattr(kind, "persist", lambda df, *a: held.append(df) or persist(df, *a))
    good = '{"department": "d", "priority": "LOW", "request_ref": "r", "channel": "' + "x" * 100 + '"}'
    batch = ev.decode(spark.createDataFrame([(good,), ("{cut",)], "value string"))
    root = scratch_path(spark, "narrow")
    ev._counts_to(f"{root}/counts", f"{root}/bad")(batch, 0)
    assert sorted(r.raw or "" for r in held[0].collect()) == ["", "{cut"]
    assert set(held[0].columns) == {"_ok", "department", "priority", "raw"}
    assert [tuple(r) for r in ev.read_counts(spark, f"{root}/counts").collect()] == [("d", "LOW", 1)]
    assert [r.raw for r in ev.read_quarantine(spark, f"{root}/bad").collect()] == ["{cut"]
