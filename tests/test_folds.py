"""Replica with folds by bucket: what is opened, what is rewritten, what a replay changes."""

from __future__ import annotations

import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vellumflow.operators.latest import newest_per
from vellumflow.sources.store import conformed
from vellumflow.streaming import folds, streams
from vellumflow.streaming.changes import write_batch

KEY, BUCKETS = ["k"], 8


def log_of(spark, n=900):
    # A third of all rows is of one key; times go back and repeat.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 97).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("t"), F.col("id").cast("string").alias("event_id"),
    )


def opened(df):
    return {re.search(r"/((?:folds/upto|changes/batch_id)=.*)/[^/]+$", f).group(1) for f in df.inputFiles()}


def batches_opened(spark, target):
    rows = folds._since(spark, target, folds._newest_folds(spark, target, BUCKETS))
    return {r[0] for r in rows.select(F.regexp_extract(F.input_file_name(), "batch_id=([0-9]+)", 1)).distinct().collect()}


def table(df):
    return sorted(map(tuple, df.select("k", "t", "event_id").collect()))


def test_stream_with_folds(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    log = log_of(spark)
    log.repartition(11, "event_id").write.parquet(source)
    log = spark.read.parquet(source)
    stream = streams.event_stream(spark, source, log.schema, files_per_batch=1)
    folds.sync(stream, KEY, "t", target, str(tmp_path / "cp"), every=4, buckets=BUCKETS).awaitTermination()
    replica = folds.replica(spark, target, KEY, "t", buckets=BUCKETS)
    assert table(replica) == table(newest_per(log, KEY, "t", "event_id"))
    # Eleven batches, folded after the fourth and the eighth.
    assert batches_opened(spark, target) == {"8", "9", "10"}
    assert len({f for f in opened(replica) if f.startswith("folds")}) == BUCKETS


def test_a_fold_rewrites_only_what_changed(spark, tmp_path):
    target = str(tmp_path)
    write_batch(log_of(spark).transform(newest_per, KEY, "t", "event_id"), 0, target)
    assert len(folds.fold(spark, target, 0, KEY, "t", buckets=BUCKETS)) == BUCKETS
    before = opened(folds.replica(spark, target, KEY, "t", buckets=BUCKETS))
    write_batch(spark.createDataFrame([(1, 99, "x")], "k long, t long, event_id string"), 1, target)
    (touched,) = folds.fold(spark, target, 1, KEY, "t", buckets=BUCKETS)
    replica = folds.replica(spark, target, KEY, "t", buckets=BUCKETS)
    now = table(replica)
    folders = {f for f in opened(replica) if f.startswith("folds")}
    assert folders == {f for f in before if f.startswith("folds") and not f.endswith(f"bucket={touched}")} | {f"folds/upto=1/bucket={touched}"}
    assert (1, 99, "x") in now and len(now) == 97
    # The batch once more, and its fold: nothing changes.
    write_batch(spark.createDataFrame([(1, 99, "x")], "k long, t long, event_id string"), 1, target)
    assert folds.fold(spark, target, 1, KEY, "t", buckets=BUCKETS) == []
    assert table(folds.replica(spark, target, KEY, "t", buckets=BUCKETS)) == now


def test_a_fold_without_manifest_is_not_seen(spark, tmp_path):
    target = str(tmp_path)
    write_batch(log_of(spark).transform(newest_per, KEY, "t", "event_id"), 0, target)
    # What a failed fold may leave.
    spark.createDataFrame([(1, 10**6, "wrong", 0)], "k long, t long, event_id string, bucket int").write.partitionBy("bucket").parquet(f"{target}/folds/upto=0")
    want = table(newest_per(log_of(spark), KEY, "t", "event_id"))
    assert table(folds.replica(spark, target, KEY, "t", buckets=BUCKETS)) == want
    folds.fold(spark, target, 0, KEY, "t", buckets=BUCKETS)
    assert table(folds.replica(spark, target, KEY, "t", buckets=BUCKETS)) == want
    with pytest.raises(ValueError):
        folds.replica(spark, target, KEY, "t", buckets=BUCKETS + 1)


def test_conformed(spark):
    rows = spark.createDataFrame([("p", "7", 1)], "prompt_id string, version string, other int")
    (row,) = conformed(rows, "prompts").collect()
    assert (row["prompt_id"], row["version"], row["content"]) == ("p", 7, None) and "other" not in row
    with pytest.raises(PySparkException, match="event_id is missing"):
        conformed(rows, "job_events").collect()
