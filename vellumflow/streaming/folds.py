"""A replica that keeps up: changes are folded by bucket of the key, and only buckets that changed are rewritten.

Layout of a target::

    changes/batch_id=7/            newest row per key of one batch
    folds/upto=7/bucket=3/         all rows of a bucket as of a batch
    manifest/upto=7/               the buckets that this fold wrote, written last

Readers open the newest fold of each bucket and the batches after the last fold. A fold that failed has no
manifest, is not seen, and is overwritten by the next try; older folds stay for readers under way.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vellumflow.operators.latest import newest_per
from vellumflow.streaming.changes import AVAILABLE_NOW, write_batch

#: Of a target's first fold on; the driver reads one manifest row per bucket.
BUCKETS = 64


def _bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _newest_folds(spark: SparkSession, target: str, buckets: int) -> dict[int, int]:
    """The batch up to which each bucket was last folded."""
    try:
        seen = spark.read.parquet(f"{target}/manifest")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    rows = seen.groupBy("bucket").agg(F.max("upto").alias("upto"), F.min("buckets").alias("lo"), F.max("buckets").alias("hi")).collect()
    if any((r["lo"], r["hi"]) != (buckets, buckets) for r in rows):
        raise ValueError(f"{target} is not folded into {buckets} buckets")
    return {r["bucket"]: r["upto"] for r in rows}


def _folded(spark: SparkSession, target: str, folds: dict[int, int], only: set[int] | None = None) -> DataFrame | None:
    paths = [f"{target}/folds/upto={upto}/bucket={b}" for b, upto in sorted(folds.items()) if only is None or b in only]
    return spark.read.parquet(*paths) if paths else None


def _since(spark: SparkSession, target: str, folds: dict[int, int]) -> DataFrame:
    return spark.read.parquet(f"{target}/changes").where(F.col("batch_id") > max(folds.values(), default=-1))


def replica(spark: SparkSession, target: str, key: list[str], sequence: str, tie: str = "event_id", buckets: int = BUCKETS) -> DataFrame:
    """The newest row per key, from the newest fold of each bucket and the batches since."""
    folds = _newest_folds(spark, target, buckets)
    rows, base = _since(spark, target, folds).drop("batch_id"), _folded(spark, target, folds)
    return newest_per(rows if base is None else rows.unionByName(base), key, sequence, tie)


def fold(spark: SparkSession, target: str, upto: int, key: list[str], sequence: str, tie: str = "event_id", buckets: int = BUCKETS) -> list[int]:
    """Fold the batches up to ``upto`` into the buckets they touch, which are returned; none if that was done before."""
    folds = _newest_folds(spark, target, buckets)
    if max(folds.values(), default=-1) >= upto:
        return []
    fresh = _since(spark, target, folds).where(F.col("batch_id") <= upto).drop("batch_id")
    touched = {r[0] for r in fresh.select(_bucket(key, buckets)).distinct().collect()}
    if touched:
        base = _folded(spark, target, folds, touched)
        newest = newest_per(fresh if base is None else fresh.unionByName(base), key, sequence, tie)
        filed = newest.withColumn("bucket", _bucket(key, buckets)).repartition("bucket")
        filed.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/folds/upto={upto}")
        listed = spark.createDataFrame([(b, buckets) for b in sorted(touched)], "bucket int, buckets int")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/upto={upto}")
    return sorted(touched)


def sync(
    stream: DataFrame, key: list[str], sequence: str, target: str, checkpoint: str,
    tie: str = "event_id", every: int = 10, buckets: int = BUCKETS, trigger: dict | None = None,
) -> StreamingQuery:
    """Replicate ``stream`` by ``key`` and fold after each ``every`` batches. The greatest ``(sequence, tie)`` wins
    whatever the order of arrival. A batch that runs again changes nothing: its own folder is replaced, and what
    a fold holds is not folded twice."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        write_batch(newest_per(batch, key, sequence, tie), batch_id, target)
        if (batch_id + 1) % every == 0:
            fold(batch.sparkSession, target, batch_id, key, sequence, tie, buckets)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )
