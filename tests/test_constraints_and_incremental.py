"""Constraints at load, the incremental load, JSON fields as variants, and the consumer that keeps state."""

from __future__ import annotations

import threading
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF0001
from servstar.operators import constraints as c
from servstar.plans import flow, incremental
from servstar.session import scratch_path
from servstar.sources.tables import SourceTables
from servstar.streaming import events as ev


def test_each_row_lists_what_it_violates(spark):
    rows = [(1, "a", 5.0, 1, 2), (2, "b", 9.0, 1, 2), (2, "c", 5.0, 7, 2), (None, "d", None, None, None), (None, "zz", 0.0, 2, 1),
            (3, None, 5.0, 2, 2)]
    df = spark.createDataFrame(rows, "k long, code string, x double, a int, b int")
    rules = [c.NotNull("code"), c.Unique(("k",)), c.Unique(("k", "code")), c.Between("x", 1, 8), c.OneOf("code", ("a", "b", "c", "d")),
             c.NotBefore("b", "a"), c.References("a", "p", "id")]
    parents = {"p": spark.createDataFrame([(1,), (2,), (2,)], "id int")}
    got = {(r.k, r.code): r.violations for r in c.with_violations(df, rules, parents).collect()}
    assert got == {(1, "a"): [], (2, "b"): ["k repeated", "x out of range"], (2, "c"): ["k repeated", "b before a", "a not in p"],
                   (None, "d"): [], (None, "zz"): ["x out of range", "code not listed", "b before a"], (3, None): ["code is null"]}
    accepted, bad = c.load_checked(df, rules, scratch_path(spark, "checked"), parents)
    assert sorted(r.k or 0 for r in accepted.collect()) == [0, 1] and accepted.columns == df.columns
    assert sorted(len(r.violations) for r in bad.collect()) == [1, 2, 3, 3]
    assert "accepted" in accepted._jdf.queryExecution().executedPlan().toString()  # a partition filter


def test_a_hot_key_is_counted_before_it_is_shuffled(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 10_000, 7).otherwise(F.col("id")).alias("k"))
    out = c.with_violations(df, [c.Unique(("k",))])
    assert out.filter("size(violations) > 0").count() == 10_000
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


STORED = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("row_hash", T.LongType()),
                       T.StructField("month", T.StringType())])


def _rows(spark, *rows):
    df = spark.createDataFrame(rows, "id long, v string, month string")
    return df.withColumn("row_hash", F.xxhash64("id", "v")).select("id", "v", "row_hash", "month")


def _stored(spark, path):
    return sorted((r.id, r.v, r.month) for r in spark.read.schema(STORED).parquet(path).collect())


def test_upsert_rewrites_only_the_months_that_change(spark):
    path = scratch_path(spark, "upsert")
    first = [(1, "a", "2024-01"), (2, "b", "2024-01"), (3, "c", "2024-02"), (4, "d", "2024-03"), (5, "e", "2024-04")]
    assert incremental.upsert(_rows(spark, *first), path, "id", STORED) == {
        "new_rows": 5, "changed_rows": 0, "removed_rows": 0, "months_written": 4}
    files = lambda m: {f for f in spark.read.schema(STORED).parquet(path).inputFiles() if m in f}
    untouched = files("month=2024-02")
    # changed, moved to another month, removed (the month's last row), late
    second = [(1, "A", "2024-01"), (2, "b", "2024-04"), (3, "c", "2024-02"), (5, "e", "2024-04"), (6, "late", "2023-12")]
    assert incremental.upsert(_rows(spark, *second), path, "id", STORED) == {
        "new_rows": 1, "changed_rows": 2, "removed_rows": 1, "months_written": 4}
    assert _stored(spark, path) == sorted(second) and files("month=2024-02") == untouched and not files("month=2024-03")
    assert incremental.upsert(_rows(spark, *second), path, "id", STORED)["months_written"] == 0
    # a delivery of changes only: what it lacks stays
    assert incremental.upsert(_rows(spark, (3, "C", "2024-05")), path, "id", STORED, complete=False)["changed_rows"] == 1
    assert _stored(spark, path) == sorted([r for r in second if r[0] != 3] + [(3, "C", "2024-05")])


def test_a_full_delivery_is_written_without_a_join(spark, monkeypatch):
    """Months to rewrite hold the rows that they were sent; keys that are NULL stay out, files stay open per month."""
    from servstar.sources import tables
    path, plans = scratch_path(spark, "no-join"), []
    write = incremental.write_by_month

    def seen(content, target):
        plans.append(content._jdf.queryExecution().executedPlan().toString())
        write(content, target)
    monkeypatch.setattr(incremental, "write_by_month", seen)
    first = [(k, f"v{k}", f"2024-0{k % 3 + 1}") for k in range(30)]
    second = [(k, f"w{k}" if k % 5 == 0 else f"v{k}", f"2024-0{k % 3 + 1}") for k in range(2, 33)]
    for rows in (first, second):
        incremental.upsert(_rows(spark, *rows, (None, "none", "2024-01")), path, "id", STORED)
        assert _stored(spark, path) == sorted(rows)
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    before = spark.conf.get(tables._OPEN_FILES, None)
    with tables.unsorted_writes(spark), tables.unsorted_writes(spark):
        assert spark.conf.get(tables._OPEN_FILES) == str(tables.OPEN_FILES)
    assert spark.conf.get(tables._OPEN_FILES, None) == before


def test_a_load_that_broke_off_is_completed_by_the_next(spark):
    """A month that a failed run deleted or left half written comes back from the source."""
    from servstar.sources.tables import delete
    path = scratch_path(spark, "broken")
    rows = [(k, f"v{k}", f"2024-0{k % 3 + 1}") for k in range(30)]
    incremental.upsert(_rows(spark, *rows), path, "id", STORED)
    delete(spark, f"{path}/month=2024-02")
    assert incremental.upsert(_rows(spark, *rows), path, "id", STORED)["new_rows"] == 10
    assert _stored(spark, path) == sorted(rows)


def test_bad_messages_are_set_aside(spark):
    good = incremental.messages_of(spark.createDataFrame(
        [(1, "R1", 2, "web", "O", "HIGH", "2024-01-31 10:00:00", "2024-02-02 00:00:00", "2024-02-01 00:00:00")],
        ", ".join(f"{n} string" if n not in ("request_id", "department_id") else f"{n} long" for n in incremental._SENT)))
    bad = spark.createDataFrame([("{cut",), ('{"request_id":"5"}',), (None,)], "value string")
    got = {r.missing: r for r in incremental.prepared(good.unionByName(bad)).collect()}
    assert set(got) == {None, "unreadable", "request_ref,priority,submitted_at"}
    assert (got[None].sla_flag, got[None].month, got[None].department_id) == (1, "2024-01", 2)


def test_variant_fields_tell_their_faults_apart(spark):
    rows = ['{"k": 5, "s": "x"}', '{"k": "7"}', '{"k": "seven"}', '{"k": null}', "{}", "{cut", None, '{"k": [1]}', "[]"]
    out = flow.variant_fields(spark.createDataFrame([(r,) for r in rows], "t string"), "t", {"k": "long", "s": "string"}).collect()
    assert [r.k_state for r in out] == ["ok", "ok", "wrong type", "missing", "missing", "unreadable", "missing", "wrong type", "missing"]
    assert [r.k for r in out][:3] == [5, 7, None] and [r.s_state for r in out][:2] == ["ok", "missing"]


# -- the stream with state ------------------------------------------------------------------------
def _messages(spark, files):
    recs = ev.encode(ev.event_records(SourceTables(spark, SF0001).table("events")))
    path = scratch_path(spark, "state-messages")
    ev.produce(recs.repartition(files), path)
    want = {(r.department, r.priority): r["count"] for r in ev.event_records(
        SourceTables(spark, SF0001).table("events")).groupBy("department", "priority").count().collect()}
    return path, want


def _counts(spark, sink):
    return {(r.department, r.priority): r.events for r in ev.read_state_counts(spark, sink).collect()}


def test_state_holds_one_row_per_key_and_a_stopped_run_goes_on(spark, monkeypatch):
    path, want = _messages(spark, 8)
    root = scratch_path(spark, "state")
    ss = ev.state_session(spark)
    monkeypatch.setattr(ev, "UPDATES_KEPT", 3)
    source = lambda: ev.message_stream(ss, path, files_per_trigger=1)
    query = ev.start_state_counts(source(), f"{root}/counts", f"{root}/checkpoint", {"processingTime": "0 seconds"})
    while not any(p.batchId >= 2 for p in query.recentProgress):
        time.sleep(0.1)
    query.stop()  # in the middle of its messages
    ev.await_all([ev.start_state_counts(source(), f"{root}/counts", f"{root}/checkpoint")])
    assert _counts(spark, f"{root}/counts") == want
    assert len(ev._snapshots(spark, f"{root}/counts")) <= 4  # updates are written together
    state = spark.read.format("statestore").load(f"{root}/checkpoint")
    assert state.count() == len(want)
    ev.await_all([ev.start_state_counts(source(), f"{root}/counts", f"{root}/checkpoint")])
    assert _counts(spark, f"{root}/counts") == want


def test_a_consumer_ends_when_idle_and_counts_what_came_meanwhile(spark):
    path, want = _messages(spark, 2)
    root = scratch_path(spark, "idle")
    ss = ev.state_session(spark)
    later = threading.Timer(3.0, lambda: ev.produce(spark.createDataFrame(
        [('{"department":"late","priority":"LOW"}',)] * 5, "value string"), path))
    later.start()
    begun = time.monotonic()
    ev.run_until_idle(ss, lambda: ev.start_state_counts(ev.message_stream(ss, path), f"{root}/counts", f"{root}/checkpoint",
                                                        {"processingTime": "0 seconds"}), seconds=6.0)
    assert time.monotonic() - begun > 8  # not before the later messages, and an idle time after them
    assert _counts(spark, f"{root}/counts") == want | {("late", "LOW"): 5}


def test_a_publish_that_fails_half_way_and_is_repeated_counts_once(spark, monkeypatch):
    import pytest
    root = scratch_path(spark, "publish")
    log, ss = f"{root}/messages", ev.state_session(spark)
    messages = spark.createDataFrame([(f'{{"department":"d{k % 3}","priority":"LOW"}}',) for k in range(30)], "value string").repartition(3)

    def drained():
        ev.await_all([ev.start_state_counts(ev.message_stream(ss, log), f"{root}/counts", f"{root}/checkpoint")])
        return sum(_counts(spark, f"{root}/counts").values())

    assert ev.publish_once(messages.limit(6), log, "first") and drained() == 6
    with monkeypatch.context() as m:
        m.setattr(ev, "rename", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ev.publish_once(messages, log, "second")  # all written, not published
    assert drained() == 6
    assert ev.publish_once(messages, log, "second") and not ev.publish_once(messages, log, "second")
    assert drained() == 36 and drained() == 36
