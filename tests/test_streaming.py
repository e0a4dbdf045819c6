"""Streams give the batch result however the input is cut, ordered or repeated."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vellumflow import vocabulary as V
from vellumflow.operators.latest import newest_per
from vellumflow.operators.sequences import stage_durations
from vellumflow.sources.derived import Derived
from vellumflow.streaming import changes, streams

STATUS = ["run_id", "event_id", "event_type", "status"]


@pytest.fixture(scope="module")
def log(spark, sf):
    return Derived(spark, sf).job_events().cache()


@pytest.fixture(scope="module")
def cuts(spark, log, tmp_path_factory):
    """The log as one file, as eight time slices, and as eight slices out of order."""
    root = tmp_path_factory.mktemp("cuts")
    paths = {}
    for name, order in (("one", None), ("many", F.col("timestamp")), ("shuffled", F.xxhash64("event_id"))):
        paths[name] = str(root / name)
        part = log.coalesce(1) if order is None else log.repartitionByRange(8, order)
        part.write.parquet(paths[name])
    return paths


def stream(spark, log, path, per_batch=1):
    return streams.event_stream(spark, path, log.schema, files_per_batch=per_batch)


@pytest.mark.parametrize("cut", ["one", "many", "shuffled"])
def test_replica_equals_batch(spark, log, cuts, tmp_path, cut):
    target = str(tmp_path / "t")
    changes.sync(stream(spark, log, cuts[cut]), ["run_id"], "timestamp", target, f"{target}/cp").awaitTermination()
    want = newest_per(log, ["run_id"], "timestamp", "event_id")
    assert rows(changes.replica(spark, target, ["run_id"], "timestamp"), *STATUS) == rows(want, *STATUS)


def test_replayed_batch_and_snapshot(spark, log, cuts, tmp_path):
    target = str(tmp_path / "t")
    changes.sync(stream(spark, log, cuts["many"]), ["run_id"], "timestamp", target, f"{target}/cp").awaitTermination()
    once = rows(changes.replica(spark, target, ["run_id"], "timestamp"), *STATUS)
    # The whole input again, from a lost checkpoint: the same folders, the same rows.
    changes.sync(stream(spark, log, cuts["many"]), ["run_id"], "timestamp", target, f"{target}/cp2").awaitTermination()
    assert rows(changes.replica(spark, target, ["run_id"], "timestamp"), *STATUS) == once


def test_snapshots(spark, log, cuts, tmp_path):
    target = str(tmp_path / "t")
    changes.sync(stream(spark, log, cuts["shuffled"]), ["run_id"], "timestamp", target, f"{target}/cp").awaitTermination()
    whole = rows(changes.replica(spark, target, ["run_id"], "timestamp"), *STATUS)
    assert changes.compact(spark, target, ["run_id"], "timestamp") == 7
    current = changes.replica(spark, target, ["run_id"], "timestamp")
    assert rows(current, *STATUS) == whole
    # Folded batches are no longer read.
    current.collect()
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "(batch_id#" in plan and "PartitionFilters: [isnotnull(batch_id" in plan
    later = log.filter("run_id = 0 or event_id = '0'").limit(1).withColumn("timestamp", F.lit("2030-01-01").cast("timestamp_ntz")).withColumn("status", F.lit("LATE"))
    changes.write_batch(later, 8, target)
    (run,) = [r.run_id for r in later.collect()]
    assert changes.compact(spark, target, ["run_id"], "timestamp") == 8
    got = changes.replica(spark, target, ["run_id"], "timestamp")
    assert rows(got.filter(F.col("run_id") == run), "status") == [("LATE",)]
    assert rows(got.filter(F.col("run_id") != run), *STATUS) == [r for r in whole if r[0] != run]


@pytest.mark.parametrize("cut", ["one", "shuffled"])
def test_each_event_once(spark, log, cuts, tmp_path, cut):
    twice = stream(spark, log, cuts[cut]).unionByName(stream(spark, log, cuts["many"]))
    target = str(tmp_path / "t")
    streams.append_to(streams.dedup_events(twice, "60 days"), target, f"{target}-cp").awaitTermination()
    assert rows(spark.read.parquet(target), "event_id") == rows(log, "event_id")


@pytest.mark.parametrize("cut", ["one", "many", "shuffled"])
def test_volume_equals_batch(spark, log, cuts, tmp_path, cut):
    target = str(tmp_path / "t")
    live = streams.live_volume(stream(spark, log, cuts[cut], 3), "60 days")
    streams.publish_updates(live, target, f"{target}/cp").awaitTermination()
    got = changes.replica(spark, target, ["window_start", "agent"], "version", "version")
    want = log.groupBy(F.date_trunc("hour", "timestamp").alias("window_start"), "agent").agg(
        F.count("*").alias("events"), F.sum(F.col("event_type").endswith("Failed").cast("long")).alias("failed")
    )
    cols = ["window_start", "agent", "events", "failed"]
    assert rows(got, *cols) == rows(want, *cols)


@pytest.mark.parametrize("cut", ["many", "shuffled"])
def test_action_once_per_run(spark, log, cuts, tmp_path, cut):
    target = str(tmp_path / "t")
    streams.append_to(streams.stage_trigger(stream(spark, log, cuts[cut]), "60 days"), target, f"{target}-cp").awaitTermination()
    want = log.filter("agent <> 'sharepoint_agent'").select("run_id", "agent", streams.triggered_action(F.col("event_type")).alias("action")).distinct().filter("action is not null")
    cols = ["run_id", "agent", "action"]
    assert rows(spark.read.parquet(target), *cols) == rows(want, *cols)


def test_uploads_clear_the_run_they_name(spark, make_log, tmp_path):
    log = make_log(
        ("1", "SharePointUploadCompleted", 0, "sharepoint_agent", "u", "2024-01-01 00:00:00", '{"summarization_run_id":12}'),
        ("2", "SharePointUploadFailed", 0, "sharepoint_agent", "u", "2024-01-01 00:01:00", '{"summarization_run_id":22}'),
        ("3", "SharePointUploadFailed", 0, "sharepoint_agent", "u", "2024-01-01 00:02:00"),
    )
    log.coalesce(1).write.parquet(str(tmp_path / "in"))
    target = str(tmp_path / "t")
    actions = streams.stage_trigger(stream(spark, log, str(tmp_path / "in")))
    streams.append_to(actions, target, f"{target}-cp").awaitTermination()
    assert rows(spark.read.parquet(target), "run_id", "action") == [(12, "clear"), (22, "clear")]


def test_silent_runs_up_to_the_newest_event(spark, make_log, tmp_path):
    log = make_log(
        ("1", "ExtractionJobStarted", 1, "extraction_agent", "u", "2024-01-01 00:00:00"),
        ("2", "ExtractionJobStarted", 2, "extraction_agent", "u", "2024-01-03 00:00:00"),
        ("3", "ExtractionJobStarted", 3, "extraction_agent", "u", "2024-01-03 05:30:00"),
        ("4", "ExtractionJobCompleted", 4, "extraction_agent", "u", "2024-01-03 06:00:00"),
    )
    log.coalesce(1).write.parquet(str(tmp_path / "in"))
    target = str(tmp_path / "t")
    live = streams.stalled_sessions(stream(spark, log, str(tmp_path / "in")), V.EXTRACTION, "1 day")
    streams.append_to(live, target, f"{target}-cp").awaitTermination()
    assert rows(spark.read.parquet(target), "run_id") == [(1,)]
    assert rows(streams.stalled_since(log, V.EXTRACTION, "1 day"), "run_id") == [(2,)]


def test_silent_runs(spark, make_log, tmp_path):
    log = make_log(
        ("1", "ExtractionJobStarted", 1, "extraction_agent", "u", "2024-01-01 00:00:00"),
        ("2", "ExtractionJobStarted", 2, "extraction_agent", "u", "2024-01-01 00:00:00"),
        ("3", "ExtractionJobCompleted", 2, "extraction_agent", "u", "2024-01-01 00:59:00"),
        ("4", "ExtractionJobStarted", 3, "extraction_agent", "u", "2024-01-01 00:00:00"),
        ("5", "ExtractionJobCompleted", 3, "extraction_agent", "u", "2024-01-01 01:01:00"),
        ("6", "JobStarted", 4, "extraction_agent", "u", "2024-01-05 00:00:00"),
    )
    log.coalesce(1).write.parquet(str(tmp_path / "in"))
    target = str(tmp_path / "t")
    live = streams.stalled_sessions(stream(spark, log, str(tmp_path / "in")), V.EXTRACTION, "1 hour")
    streams.append_to(live, target, f"{target}-cp").awaitTermination()
    assert rows(spark.read.parquet(target), "run_id") == [(1,), (3,)]
    done = stage_durations(log).filter("duration_seconds <= 3600")
    assert rows(done, "run_id") == [(2,)]
