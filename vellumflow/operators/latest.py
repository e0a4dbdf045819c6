"""Newest row per key, and the orderings that go with it.

``newest_per`` is an aggregation, so every task first reduces its own rows to
one per key: a key that holds a third of the table still shuffles one row per
task.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions.text import preview
from vellumflow.functions.times import instant
from vellumflow.operators.joins import lookup


def newest_per(df: DataFrame, keys: list[str], by: str, tie: str, columns: list[str] | None = None) -> DataFrame:
    """The row with the greatest ``(by, tie)`` of each key; NULL ``by`` loses.

    The other columns follow in the compared struct, so even rows that agree in
    both give the same result on every run.
    """
    rest = [c for c in (columns or df.columns) if c not in keys]
    ordered = list(dict.fromkeys([by, tie, *rest]))
    best = F.max(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ordered)])).alias("_newest")
    return df.groupBy(*keys).agg(best).select(
        *keys, *[F.col(f"_newest._{ordered.index(c)}").alias(c) for c in rest]
    )


def newest_of(df: DataFrame, wanted: DataFrame, key: str, by: str, tie: str, columns: list[str]) -> DataFrame:
    """As ``newest_per``, for the wanted keys alone.

    The newest rows are found by key, time and id; the other columns, texts among them, are
    taken from these rows only.
    """
    newest = newest_per(df.select(key, by, tie), [key], by, tie, [tie])
    chosen = wanted.join(newest, key)
    return newest_per(lookup(df, chosen, [key, tie], "left_semi"), [key], by, tie, columns)


def job_status_latest(ev: DataFrame) -> DataFrame:
    """One row per run: its newest event."""
    newest = newest_per(ev, ["run_id"], "timestamp", "event_id", ["agent", "sp_used", "event_type", "timestamp"])
    return newest.select(
        "run_id", "agent", "sp_used",
        F.col("event_type").alias("latest_status"),
        F.col("timestamp").alias("last_updated"),
    )


def latest_event(ev: DataFrame) -> DataFrame:
    """Newest event of each (run, agent)."""
    return newest_per(ev, ["run_id", "agent"], "timestamp", "event_id")


def latest_summary(su: DataFrame) -> DataFrame:
    """Newest summary text of each summarization run."""
    return newest_per(su, ["summarization_run_id"], "summarized_at", "summary_id", ["summary_text"])


def summary_for_run(requested: DataFrame, su: DataFrame) -> DataFrame:
    """Newest summary text of each requested run, NULL for a miss."""
    wanted = requested.select("summarization_run_id").filter(F.col("summarization_run_id").isNotNull()).distinct()
    newest = newest_of(su, wanted, "summarization_run_id", "summarized_at", "summary_id", ["summary_text"])
    return wanted.join(newest, "summarization_run_id", "left")


def latest_extraction(ex: DataFrame, requested: DataFrame) -> DataFrame:
    """Newest extraction of each requested run; ``found`` is false for a miss."""
    wanted = requested.select("extraction_run_id").distinct()
    newest = newest_of(
        ex, wanted, "extraction_run_id", "extracted_at", "extraction_id",
        ["extraction_id", "document_path", "extracted_text", "page_count", "extracted_at"],
    )
    return wanted.join(newest, "extraction_run_id", "left").select(
        "extraction_run_id", "extraction_id", "document_path", "extracted_text", "page_count", "extracted_at",
        F.col("extraction_id").isNotNull().alias("found"),
    )


def active_prompt(prompts: DataFrame) -> DataFrame:
    """The active row with the highest version of each prompt."""
    return newest_per(
        prompts.filter("active"), ["prompt_id"], "version", "approved_at",
        ["version", "content", "approved_by", "approved_at"],
    )


def pending_workflow(st: DataFrame, as_of: datetime | None = None, hours: int = 2) -> DataFrame:
    """The newest in-progress workflow of each user within the look-back."""
    open_rows = st.filter(
        (F.col("status") == V.IN_PROGRESS) & (F.col("triggered_at") > instant(as_of, timedelta(hours=hours)))
    )
    return newest_per(
        open_rows, ["user_id"], "triggered_at", "state_id",
        ["state_id", "document_path", "extraction_run_id", "summarization_run_id", "current_stage"],
    )


def recent_events(ev: DataFrame, n: int = 10) -> DataFrame:
    return ev.orderBy(F.col("timestamp").desc(), F.col("event_id").desc()).limit(n)


def audit_tail(ev: DataFrame, n: int = 10) -> DataFrame:
    """The columns an auditor reads, newest first."""
    return recent_events(ev, n).select("event_type", "run_id", "agent", "sp_used", "status", "timestamp")


def recent_extractions(ex: DataFrame, n: int = 5) -> DataFrame:
    return ex.orderBy(F.col("extracted_at").desc_nulls_last(), F.col("extraction_id").desc()).limit(n)


def extraction_preview(ex: DataFrame, n: int = 5, chars: int = 500) -> DataFrame:
    """Newest extractions with the start of their text."""
    return recent_extractions(ex, n).select(
        "extraction_id", "document_path", preview(F.col("extracted_text"), chars).alias("preview"),
        "extracted_by", "extracted_at",
    )


def recent_checkpoints(cp: DataFrame, n: int = 10) -> DataFrame:
    """Newest conversation checkpoints by the time inside their JSON body."""
    at = F.get_json_object("checkpoint", "$.ts").try_cast("timestamp_ntz")
    return (
        cp.select("thread_id", "checkpoint_ns", at.alias("timestamp"))
        .orderBy(F.col("timestamp").desc_nulls_last(), F.col("thread_id").desc())
        .limit(n)
    )
