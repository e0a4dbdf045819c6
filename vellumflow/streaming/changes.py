"""Keyed replica of a stream, kept as per-batch change files.

Each micro-batch is reduced to one row per key and written to its own
``batch_id`` folder, so a replayed batch overwrites itself. The replica is the
newest row per key over those folders. Nothing is rewritten per batch; a
snapshot folds the changes together now and then.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vellumflow.operators.latest import newest_per

AVAILABLE_NOW = {"availableNow": True}


def write_batch(rows: DataFrame, batch_id: int, target: str) -> None:
    """Write one batch's folder, replacing what an earlier try left."""
    rows.write.mode("overwrite").parquet(f"{target}/changes/batch_id={batch_id}")


def sync(
    stream: DataFrame, key: list[str], sequence: str, target: str, checkpoint: str,
    tie: str = "event_id", trigger: dict | None = None,
) -> StreamingQuery:
    """Replicate ``stream`` by ``key``; the greatest ``(sequence, tie)`` wins
    whatever the order of arrival."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        write_batch(newest_per(batch, key, sequence, tie), batch_id, target)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def _snapshots(spark: SparkSession, target: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{target}/snapshots")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def replica(spark: SparkSession, target: str, key: list[str], sequence: str, tie: str = "event_id") -> DataFrame:
    """Current rows: the newest snapshot, if any, and the batches after it,
    newest per key. Folders of older batches and snapshots are not read."""
    rows = spark.read.parquet(f"{target}/changes")
    snapshots = _snapshots(spark, target)
    if snapshots is None:
        rows = rows.drop("batch_id")
    else:
        upto = snapshots.agg(F.max("upto")).first()[0]
        rows = rows.filter(F.col("batch_id") > upto).drop("batch_id")
        rows = rows.unionByName(snapshots.filter(F.col("upto") == upto).drop("upto"))
    return newest_per(rows, key, sequence, tie)


def compact(spark: SparkSession, target: str, key: list[str], sequence: str, tie: str = "event_id") -> int:
    """Fold all batches so far into a snapshot; returns the last batch in it.

    A snapshot becomes visible when its job commits, so a failed one is as if
    it never ran.
    """
    upto = spark.read.parquet(f"{target}/changes").agg(F.max("batch_id")).first()[0]
    replica(spark, target, key, sequence, tie).write.mode("overwrite").parquet(f"{target}/snapshots/upto={upto}")
    return upto
