"""Streams with timers against the batch rules, in parts, out of order and with a busy key."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from vellumflow import vocabulary as V
from vellumflow.operators import limits
from vellumflow.streaming import streams, timers

SCHEMA = "event_id string, event_type string, run_id long, agent string, triggered_by string, timestamp timestamp_ntz"


def in_parts(spark, folder, rows, parts):
    """The rows in files, read one a batch; within a file and a day the order is mixed."""
    for i in range(parts):
        spark.createDataFrame(rows[len(rows) * i // parts : len(rows) * (i + 1) // parts], "event_id string, event_type string, run_id long, agent string, triggered_by string, at long").select(
            "event_id", "event_type", "run_id", "agent", "triggered_by", F.timestamp_micros("at").cast("timestamp_ntz").alias("timestamp")
        ).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.schema(SCHEMA).parquet(folder), streams.event_stream(spark, folder, spark.read.schema(SCHEMA).parquet(folder).schema, files_per_batch=1)


def mixed(rows, rng):
    """Nearly by time: no row comes more than twelve hours late."""
    return sorted(rows, key=lambda r: r[5] + rng.randrange(12 * 3600 * 1_000_000))


def test_bursts(spark, tmp_path):
    rng = random.Random(3)
    second = 1_000_000
    # Every third event is of one user; equal times, and events exactly one interval apart.
    rows = [(str(i), "x", 1, "a", "hot" if i % 3 == 0 else f"u{i % 7}" if i % 20 else None, 1_700_000_000 * second + rng.randrange(0, 8 * 86400, 1800) * second) for i in range(600)]
    log, stream = in_parts(spark, str(tmp_path / "in"), mixed(rows, rng), 4)
    found = timers.bursts(stream, "triggered_by", "timestamp", "event_id", 3, 7200)
    streams.append_to(found, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    emitted = spark.read.parquet(str(tmp_path / "out"))
    held = timers.held_bursts(spark, str(tmp_path / "cp"), 3, 7200)
    want = limits.bursts(log, "triggered_by", "timestamp", "event_id", 3, 7200)
    got = sorted((r["key"], r["event_id"], r["at"], r["since"]) for r in emitted.unionByName(held).collect())
    assert got == sorted((r["triggered_by"], r["event_id"], r["timestamp"], r["since"]) for r in want.collect())
    assert emitted.count() > 0 and len(got) > 30
    # State is bounded by the watermark: no slice over at the last batch's watermark is held.
    state = spark.read.format("statestore").option("stateVarName", "events").load(str(tmp_path / "cp"))
    assert state.agg(F.min((F.col("key._slice") + 1) * 7200)).first()[0] > max(r[5] for r in rows) / second - 86400 - 1


def test_silent_runs(spark, tmp_path):
    rng = random.Random(4)
    agent, second = V.EXTRACTION, 1_000_000
    kinds = [agent.started, agent.started, agent.completed, agent.failed]
    rows = [
        (str(i), rng.choice(kinds), 5 if i % 3 == 0 else i % 60 or None, agent.name if i % 9 else "other", None, 1_700_000_000 * second + rng.randrange(0, 6 * 86400, 900) * second + rng.randrange(second))
        for i in range(500)
    ]
    log, stream = in_parts(spark, str(tmp_path / "in"), mixed(rows, rng), 3)
    streams.append_to(timers.silent_runs(stream, agent), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    emitted = spark.read.parquet(str(tmp_path / "out"))
    got = emitted.unionByName(timers.held_silent_runs(spark, str(tmp_path / "cp"), agent))
    # The same log through session windows, cut at its newest event.
    newest = log.where(F.col("agent") == agent.name).agg(F.max("timestamp")).first()[0]
    want = streams.stalled_sessions(log, agent).where(F.col("gave_up_at") <= F.lit(newest))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert emitted.count() > 10 and got.count() > emitted.count()


def test_any_state_store(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        _, stream = in_parts(spark, str(tmp_path / "in"), [(str(i), "x", 1, "a", "u", 10**15 + i) for i in range(5)], 1)
        streams.append_to(timers.bursts(stream, "triggered_by", "timestamp", "event_id", 3, 60), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert timers.held_bursts(spark, str(tmp_path / "cp"), 3, 60).count() == 2
    finally:
        spark.conf.set(provider, before)


def test_an_event_at_the_end_of_the_timeout_comes_too_late(spark, tmp_path):
    agent, start, hour = V.EXTRACTION, 1_700_000_000_000_000, 3600 * 1_000_000
    rows = [("1", agent.started, 7, agent.name, None, start), ("2", agent.completed, 7, agent.name, None, start + hour)]
    rows += [("3", agent.started, 8, agent.name, None, start), ("4", agent.completed, 8, agent.name, None, start + hour - 1)]
    _, stream = in_parts(spark, str(tmp_path / "in"), rows, 1)
    streams.append_to(timers.silent_runs(stream, agent), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r["run_id"] for r in timers.held_silent_runs(spark, str(tmp_path / "cp"), agent).collect()] == [7]


def test_nothing(spark, tmp_path):
    log, stream = in_parts(spark, str(tmp_path / "in"), [("1", "x", None, V.EXTRACTION.name, None, 1)], 1)
    streams.append_to(timers.silent_runs(stream, V.EXTRACTION), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert timers.held_silent_runs(spark, str(tmp_path / "cp"), V.EXTRACTION).count() == 0
    streams.append_to(timers.bursts(stream, "triggered_by", "timestamp", "event_id", 1, 60), str(tmp_path / "out2"), str(tmp_path / "cp2")).awaitTermination()
    assert timers.held_bursts(spark, str(tmp_path / "cp2"), 1, 60).count() == 0


def test_bursts_of_many_keys_are_held_in_few_groups(spark, tmp_path):
    """State holds an element per group of keys, slice and batch, not one per key; odd keys and missing ids stay as they are."""
    odd = ['a"b', "a,b]", "é\n\U0001F600\\", ""]
    rows = [(None if i % 5 == 0 else str(i), "x", 1, "a", odd[i % 4] if i < 40 else f"u{i % 200}", 10**15 + i // 4 * 1_000_000) for i in range(840)]
    log, stream = in_parts(spark, str(tmp_path / "in"), rows, 2)
    streams.append_to(timers.bursts(stream, "triggered_by", "timestamp", "event_id", 2, 3600), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    held = timers.held_bursts(spark, str(tmp_path / "cp"), 2, 3600)
    want = limits.bursts(log, "triggered_by", "timestamp", "event_id", 2, 3600)
    assert sorted(map(repr, (tuple(r) for r in held.collect()))) == sorted(repr(tuple(r)) for r in want.collect()) and held.count() > 400
    state = spark.read.format("statestore").option("stateVarName", "events").load(str(tmp_path / "cp"))
    assert state.count() <= 2 * 2 * 32


def test_expired_bursts_with_missing_ids_and_equal_times(spark, tmp_path):
    rows = [(i, "x", 1, "a", "u", 10**15) for i in (None, "1", None)] + [("9", "x", 1, "a", "z", 10**15 + 10 * 86400 * 1_000_000)]
    log, stream = in_parts(spark, str(tmp_path / "in"), rows, 2)
    streams.append_to(timers.bursts(stream, "triggered_by", "timestamp", "event_id", 2, 3600), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    emitted = spark.read.parquet(str(tmp_path / "out"))
    assert [(r["key"], r["event_id"]) for r in emitted.collect()] == [("u", "1")]
