"""Operational metrics over the event log, usage log and chat messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vellumflow import vocabulary as V
from vellumflow.functions.text import normalized


def _truncated(unit: str, column: str, kind: T.DataType) -> Column:
    """Start of the hour or day, in the type of the column."""
    return F.date_trunc(unit, column).cast(kind)


def request_volume(ev: DataFrame) -> DataFrame:
    """Requests per hour and per day; days are summed from the hours."""
    kind = ev.schema["timestamp"].dataType
    hours = ev.groupBy(_truncated("hour", "timestamp", kind).alias("hour")).agg(F.count("*").alias("n"))
    grains = F.array(
        F.struct(F.lit("hour").alias("grain"), F.col("hour").alias("bucket_start")),
        F.struct(F.lit("day").alias("grain"), _truncated("day", "hour", kind).alias("bucket_start")),
    )
    return (
        hours.select(F.explode(grains).alias("g"), "n")
        .groupBy("g.grain", "g.bucket_start")
        .agg(F.sum("n").alias("requests"))
    )


def latency_percentiles(
    usage: DataFrame, points: tuple[float, ...] = (0.5, 0.95, 0.99), width: int = 1000
) -> DataFrame:
    """Exact interpolated latency percentiles per agent.

    Equal latencies are counted before the shuffle. The counts per range of
    ``width`` ms say which range holds each wanted rank; only the at most
    ``width`` distinct values of such a range are ever ranked together.
    """
    counts = usage.filter(F.col("latency_ms").isNotNull()).groupBy("agent_id", "latency_ms").agg(
        F.count("*").alias("n")
    )
    # Stating what the join below implies keeps its two inputs the same plan,
    # so the counted values are read once.
    bucketed = counts.withColumn("bucket", F.floor(F.col("latency_ms") / width)).filter(
        F.col("bucket").isNotNull() & F.col("agent_id").isNotNull()
    )
    before = Window.partitionBy("agent_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = bucketed.groupBy("agent_id", "bucket").agg(F.sum("n").alias("range_n")).withColumns(
        {
            "below": F.coalesce(F.sum("range_n").over(before), F.lit(0)),
            "total": F.sum("range_n").over(Window.partitionBy("agent_id")),
        }
    )
    # Each percentile needs the values at the two ranks around its position.
    position = F.col("p") * (F.col("total") - 1)
    wanted = (
        ranges.withColumn("p", F.explode(F.array(*[F.lit(p) for p in points])))
        .withColumn("position", position)
        .withColumn("rank", F.explode(F.array(F.floor("position"), F.ceil("position"))))
        .filter((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("range_n")))
        .select("agent_id", "bucket", "p", "position", "rank", "below")
        .distinct()
    )
    upto = Window.partitionBy("agent_id", "bucket").orderBy("latency_ms")
    ranked = bucketed.withColumn("upto", F.sum("n").over(upto))
    at_rank = ranked.join(wanted, ["agent_id", "bucket"]).filter(
        (F.col("below") + F.col("upto") > F.col("rank")) & (F.col("below") + F.col("upto") - F.col("n") <= F.col("rank"))
    )
    values = at_rank.groupBy("agent_id", "p").agg(
        F.min("latency_ms").alias("lo"), F.max("latency_ms").alias("hi"), F.first("position").alias("position")
    )
    fraction = F.col("position") - F.floor("position")
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * fraction
    return values.groupBy("agent_id").agg(
        *[F.max(F.when(F.col("p") == p, F.round(value, 4))).alias(f"p{round(p * 100)}") for p in points]
    )


def error_rates(ev: DataFrame) -> DataFrame:
    """Events and their share per agent and type, with a failure mark."""
    counts = ev.groupBy("agent", "event_type").agg(F.count("*").alias("events"))
    total = F.sum("events").over(Window.partitionBy("agent"))
    return counts.select(
        "agent", "event_type", "events",
        total.alias("agent_events"),
        F.col("event_type").endswith("Failed").alias("is_failure"),
        F.round(F.col("events") / total, 6).alias("rate"),
    )


def cost_per_request(usage: DataFrame) -> DataFrame:
    """Cost and tokens per agent."""
    return usage.groupBy("agent_id").agg(
        F.count("*").alias("requests"),
        F.sum("cost").alias("total_cost"),
        F.sum(F.col("input_tokens").cast("long")).alias("input_tokens"),
        F.sum(F.col("output_tokens").cast("long")).alias("output_tokens"),
    ).withColumn("avg_cost", F.round(F.col("total_cost").cast("double") / F.col("requests"), 6))


def documents_processed(ev: DataFrame) -> DataFrame:
    """Distinct completed extraction runs per day, deduplicated before counting."""
    done = ev.filter(F.col("event_type") == V.EXTRACTION.completed)
    return (
        done.select(F.to_date("timestamp").alias("day"), "run_id").distinct()
        .groupBy("day").agg(F.count("*").alias("documents"))
    )


def top_queries(messages: DataFrame, n: int = 10) -> DataFrame:
    """The most common messages after normalization."""
    return (
        messages.groupBy(normalized(F.col("content")).alias("message"))
        .agg(F.count("*").alias("asked"))
        .orderBy(F.col("asked").desc(), F.col("message"))
        .limit(n)
    )


def budget_alerts(usage: DataFrame, threshold: float) -> DataFrame:
    """Agent days whose cost exceeds the budget."""
    return (
        usage.groupBy("agent_id", F.to_date("timestamp").alias("day"))
        .agg(F.sum("cost").alias("cost"))
        .filter(F.col("cost") > F.lit(threshold).cast("decimal(20,4)"))
    )


def rate_limit_violations(messages: DataFrame, limit: int, window: str = "1 hour") -> DataFrame:
    """User windows with more requests than allowed."""
    return (
        messages.groupBy("user_id", F.window("ts", window).alias("w"))
        .agg(F.count("*").alias("requests"))
        .filter(F.col("requests") > limit)
        .select("user_id", F.col("w.start").alias("window_start"), "requests")
    )


def security_events(ev: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Hours in which a principal was far busier than its own mean, or failed.

    Works on hourly counts, which grow with time and principals, not events.
    """
    hour = _truncated("hour", "timestamp", ev.schema["timestamp"].dataType)
    hours = ev.groupBy("sp_used", hour.alias("hour")).agg(
        F.count("*").alias("n"),
        F.sum(F.col("event_type").endswith("Failed").cast("long")).alias("failed"),
    )
    own = Window.partitionBy("sp_used")
    mean = F.sum("n").over(own) / F.count("*").over(own)
    mean_sq = F.sum(F.col("n") * F.col("n")).over(own) / F.count("*").over(own)
    stats = hours.withColumns({"_mean": mean, "_sq": mean_sq}).withColumn(
        "threshold", F.col("_mean") + F.lit(sigmas) * F.sqrt(F.greatest(F.lit(0.0), F.col("_sq") - F.col("_mean") * F.col("_mean")))
    )
    return stats.filter((F.col("n") > F.col("threshold")) | (F.col("failed") > 0)).select(
        "sp_used", "hour", "n", "failed",
        F.round("threshold", 4).alias("threshold"),
        (F.col("n") > F.col("threshold")).alias("unusual"),
    )
