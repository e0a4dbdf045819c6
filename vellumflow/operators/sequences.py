"""Order-dependent facts per key: gaps, durations, stalls.

A key may own a third of the log, so no step sorts or collects all events of a
key. Events are first grouped by (key, minute); only one row per minute is
carried to the step that looks across the key's whole history.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions.times import instant, micros_between, seconds_between, whole_seconds

SLICE_SECONDS = 60
EPOCH = datetime(1970, 1, 1)


def _slice(ts: Column, seconds: int) -> Column:
    """Number of the time slice; grows with ``ts`` in every time zone."""
    return F.floor(whole_seconds(ts, instant(EPOCH)) / seconds)


def event_gaps(ev: DataFrame, key: str = "triggered_by", slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Time since the previous event of the same key; NULL for the first.

    Inside a slice ``lag`` answers directly. The first event of a slice needs the
    last event of the previous non-empty slice: an aggregate with one row per slice
    goes through a second window and is joined back by slice, which is how the
    events are partitioned already.
    """
    rows = ev.select("event_id", key, "timestamp").withColumn("_slice", _slice(F.col("timestamp"), slice_seconds))
    ordered = Window.partitionBy(key, "_slice").orderBy("timestamp", "event_id")
    inner = rows.withColumn("_prev", F.lag("timestamp").over(ordered))
    ends = rows.groupBy(key, "_slice").agg(F.max("timestamp").alias("_last"))
    across = Window.partitionBy(key).orderBy("_slice")
    carried = ends.select(F.col(key).alias("_key"), F.col("_slice").alias("_at"), F.lag("_last").over(across).alias("_carried"))
    linked = inner.join(carried, F.col(key).eqNullSafe(F.col("_key")) & F.col("_slice").eqNullSafe(F.col("_at")), "left")
    prev = F.coalesce("_prev", "_carried")
    return linked.withColumn("prev_timestamp", prev).select(
        "event_id", key, "timestamp", "prev_timestamp",
        (micros_between(F.col("timestamp"), F.col("prev_timestamp")) / 1_000_000).alias("gap_seconds"),
    )


def stage_durations(ev: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Per run: first start, first terminal event after it, and the duration.

    Run 0 stands for unrelated failures and is left out.
    """
    kind = F.col("event_type")
    terminal = kind.endswith("Completed") | kind.endswith("Failed")
    keys = ["run_id", "agent"]
    rows = ev.filter((F.col("run_id") != V.NO_RUN) & (kind.endswith("Started") | terminal)).select(
        *keys,
        _slice(F.col("timestamp"), slice_seconds).alias("_slice"),
        F.when(kind.endswith("Started"), F.col("timestamp")).alias("_start"),
        F.when(terminal, F.col("timestamp")).alias("_end"),
    )
    # Within a slice: its first start, and its first terminal event after that.
    in_slice = Window.partitionBy(*keys, "_slice")
    marked = rows.withColumn("_slice_start", F.min("_start").over(in_slice))
    after = F.when(F.col("_end") >= F.col("_slice_start"), F.col("_end"))
    slices = marked.groupBy(*keys, "_slice").agg(
        F.min("_slice_start").alias("_slice_start"),
        F.min(F.when(F.col("_slice_start").isNotNull(), F.col("_slice"))).alias("_start_slice"),
        F.min(after).alias("_end_after"),
        F.min("_end").alias("_first_end"),
    )
    # Across slices: the run starts in its first slice with a start; it ends
    # there or at the first terminal event of a later slice.
    across = Window.partitionBy(*keys)
    candidates = slices.withColumns(
        {"_started": F.min("_slice_start").over(across), "_from": F.min("_start_slice").over(across)}
    ).withColumn(
        "_candidate",
        F.when(F.col("_slice") == F.col("_from"), F.col("_end_after")).when(
            F.col("_slice") > F.col("_from"), F.col("_first_end")
        ),
    )
    runs = candidates.groupBy(*keys).agg(
        F.min("_started").alias("started_at"), F.min("_candidate").alias("finished_at")
    )
    return runs.filter(F.col("started_at").isNotNull()).select(
        *keys, "started_at", "finished_at",
        (micros_between(F.col("finished_at"), F.col("started_at")) / 1_000_000).alias("duration_seconds"),
    )


def timeout_minutes(agent: Column) -> Column:
    """Job timeout of an agent, NULL when it has none."""
    chain = F
    for a in V.AGENTS:
        if a.timeout_minutes is not None:
            chain = chain.when(agent == a.name, F.lit(a.timeout_minutes))
    return chain.otherwise(F.lit(None).cast("int"))


def stalled_runs(ev: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Runs that started but had no terminal event within the job timeout."""
    runs = stage_durations(ev).withColumn("timeout_min", timeout_minutes(F.col("agent")))
    limit = F.col("timeout_min") * 60
    waited = seconds_between(F.coalesce(F.col("finished_at"), instant(as_of).cast("timestamp_ntz")), F.col("started_at"))
    return runs.filter(waited > limit).select(
        "run_id", "agent", "started_at", "finished_at", "timeout_min",
        F.when(F.col("finished_at").isNull(), "open").otherwise("late").alias("state"),
    )
