"""Latency over time as mergeable quantile sketches.

An hour of an agent is one sketch of bounded size, whatever the number of requests in it. Days, or any
longer time, are merged from the hours without the requests, and a stream adds sketches of what is new.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vellumflow.streaming.changes import AVAILABLE_NOW, write_batch

#: Size of a sketch: quantiles are exact up to this many values, beyond it their ranks are off by less than 1 %.
K = 400


def hourly(rows: DataFrame, key: str, ts: str, value: str, k: int = K) -> DataFrame:
    """(key, hour, sketch): one sketch per key and hour. Rows without time or value are left out; tasks sketch
    their own rows before the shuffle, so a key with most of the rows costs one sketch per task and hour."""
    hour = F.date_trunc("hour", ts).cast(rows.schema[ts].dataType)
    known = rows.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
    return known.groupBy(key, hour.alias("hour")).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged(sketches: DataFrame, key: str, unit: str, k: int = K) -> DataFrame:
    """(key, unit, sketch): the sketches of each key and ``unit`` (hour, day, month ...) as one."""
    at = F.date_trunc(unit, "hour").cast(sketches.schema["hour"].dataType)
    return sketches.groupBy(key, at.alias(unit)).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantiles(sketch: str | Column, points: tuple[float, ...] = (0.5, 0.95, 0.99)) -> list[Column]:
    """``requests`` and one column per point: the smallest value at or below which that share of values lies."""
    at = [F.kll_sketch_get_quantile_double(sketch, F.lit(p)).alias(f"p{round(p * 100)}") for p in points]
    return [F.kll_sketch_get_n_double(sketch).alias("requests"), *at]


def over_time(sketches: DataFrame, key: str, units: tuple[str, ...] = ("hour", "day")) -> DataFrame:
    """(grain, bucket_start, key, requests, p50, p95, p99) for each unit."""
    def grain(unit: str) -> DataFrame:
        return merged(sketches, key, unit).select(F.lit(unit).alias("grain"), F.col(unit).alias("bucket_start"), key, *quantiles("sketch"))

    return reduce(DataFrame.unionByName, [grain(u) for u in units])


def keep(stream: DataFrame, key: str, ts: str, value: str, target: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Sketch each batch of a stream into its own folder. There is no state and no watermark: an event that
    comes late adds to the sketch of its hour, and a batch that runs again replaces its own folder."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        write_batch(hourly(batch, key, ts, value), batch_id, target)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def kept(spark: SparkSession, target: str) -> DataFrame:
    """(key, hour, sketch) of all batches; an hour has one row per batch that touched it, which merging sums up."""
    return spark.read.parquet(f"{target}/changes").drop("batch_id")
