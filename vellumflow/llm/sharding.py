"""Uniform sharding by a two-pass external shuffle, DataFrame operations only.

Pass one deals the records over buckets by a seeded hash of the key and the row's
place, so equal keys and repeated rows spread like all others, and writes them. Pass
two gathers each bucket, which fits in memory, in a task of its own, permutes it with a
seeded Fisher-Yates shuffle (``shuffle``) and writes it. A record's position is its place in the bucket
plus the sizes of the buckets before; position p goes to shard p mod n, slot p div n.

Law ``rows``: the shards' counts differ by at most one, and slots are gapless from 0.
Buckets are sized by rows and, given a size column, by bytes, on average; one record is
never split. A bucket's permutation is
written once, so a task that runs again replaces its own output and nothing is lost.

Defined results: null keys and texts are records like others, repeated rows all stay.
All columns are kept; ``shard`` and ``slot`` replace columns of these names. An empty
table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vellumflow.llm.tables import Tables

BUCKET_ROWS = 50_000
BUCKET_BYTES = 64 << 20
BUCKET, RECORD, PLACE = "_bucket", "_record", "_place"


def shuffle_into_shards(
    df: DataFrame, shards: int, folder: str, key: str, seed: int = 0, size: str | None = None,
    bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``df`` with ``shard`` and ``slot``; ``folder`` holds the buckets, those of pass one until pass two is written."""
    spark = df.sparkSession
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot")]
    whole = df.agg(F.count(F.lit(1)).alias("n"), (F.sum(size) if size else F.lit(0)).alias("bytes")).first()
    buckets = max(1, -(-whole["n"] // bucket_rows), -(-(whole["bytes"] or 0) // bucket_bytes))

    place = F.monotonically_increasing_id()
    scattered = df.select(F.struct(*kept).alias(RECORD), place.alias(PLACE), F.xxhash64(F.lit(seed), F.col(key)).alias("_key"))
    scattered = scattered.select(F.pmod(F.xxhash64("_key", PLACE), F.lit(buckets)).cast("int").alias(BUCKET), PLACE, RECORD)
    first_pass = Tables(spark)
    first_pass.paths.append(f"{folder}/scattered")
    scattered.write.parquet(f"{folder}/scattered", compression="zstd")

    back = spark.read.parquet(f"{folder}/scattered")
    members = back.repartitionById(buckets, BUCKET).groupBy(BUCKET).agg(F.sort_array(F.collect_list(F.struct(PLACE, RECORD))).alias("members"))
    permuted = members.select(BUCKET, F.posexplode(F.shuffle("members", F.lit(seed))).alias("at", "member"))
    permuted.select(BUCKET, "at", f"member.{RECORD}").write.parquet(f"{folder}/shuffled", compression="zstd")
    first_pass.discard()

    shuffled = spark.read.parquet(f"{folder}/shuffled")
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    sizes = shuffled.groupBy(BUCKET).count().select(BUCKET, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    position = F.col("at") + F.col("before")
    return shuffled.join(F.broadcast(sizes), BUCKET).select(
        f"{RECORD}.*", (position % shards).cast("int").alias("shard"), F.expr(f"(at + before) div {int(shards)}").alias("slot")
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder per shard, its records in slot order."""
    rows = sharded.repartition("shard").sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").parquet(folder)
