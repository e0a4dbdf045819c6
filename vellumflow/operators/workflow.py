"""The workflow state machine and the state-table updates."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions.times import instant
from vellumflow.operators.joins import lookup
from vellumflow.operators.latest import latest_event, pending_workflow
from vellumflow.operators.status import status_of

STATE_COLUMNS = [
    "state_id", "user_id", "document_path", "extraction_run_id", "summarization_run_id",
    "current_stage", "triggered_at", "status",
]


def _stage() -> Column:
    return F.col("current_stage")


def with_run_status(st: DataFrame, ev: DataFrame) -> DataFrame:
    """Add the status of the run each workflow waits for.

    A workflow waits for one run at a time, so its stage first names that run
    and agent, and one join on (run, agent) serves every stage.
    """
    run = F.when(_stage() == V.EXTRACTING, F.col("extraction_run_id")).when(
        _stage() == V.SUMMARIZING, F.col("summarization_run_id")
    )
    agent = F.when(_stage() == V.EXTRACTING, V.EXTRACTION.name).when(
        _stage() == V.SUMMARIZING, V.SUMMARIZATION.name
    )
    waiting = st.withColumns({"run_id": run, "agent": agent})
    jobs = ev.filter(F.col("agent").isin(V.EXTRACTION.name, V.SUMMARIZATION.name) & (F.col("run_id") != V.NO_RUN))
    newest = latest_event(jobs.select("run_id", "agent", "event_type", "timestamp", "event_id")).select(
        "run_id", "agent", "event_type", F.col("timestamp").alias("event_at")
    )
    joined = lookup(waiting, newest, ["run_id", "agent"], spread_by="state_id")
    status = F.when(_stage() == V.EXTRACTING, status_of(F.col("event_type"), V.EXTRACTION)).when(
        _stage() == V.SUMMARIZING, status_of(F.col("event_type"), V.SUMMARIZATION)
    )
    return joined.withColumn("run_status", status)


def next_action() -> Column:
    """Decision table over ``current_stage`` and ``run_status``."""
    run = F.col("run_status")
    busy = _stage().isin(V.EXTRACTING, V.SUMMARIZING)
    return (
        F.when((_stage() == V.EXTRACTING) & (run == "COMPLETED"), "start_summarization")
        .when((_stage() == V.SUMMARIZING) & (run == "COMPLETED"), "upload")
        .when(busy & (run == "FAILED"), "clear")
        .when(busy, "wait")
        .when(_stage() == V.DONE, "clear")
        .otherwise("unknown_state")
    )


def decide(with_status: DataFrame) -> DataFrame:
    """Add action, next stage and next status."""
    return with_status.withColumn("action", next_action()).withColumns(
        {
            "next_stage": F.when(F.col("action") == "start_summarization", V.SUMMARIZING)
            .when(F.col("action") == "upload", V.DONE)
            .otherwise(_stage()),
            "next_status": F.when(F.col("action") == "clear", V.WF_COMPLETED).otherwise(F.col("status")),
        }
    )


def advance(st: DataFrame, ev: DataFrame, as_of: datetime | None = None, hours: int = 2) -> DataFrame:
    """The next step of every in-progress workflow within the look-back."""
    open_rows = st.filter(
        (F.col("status") == V.IN_PROGRESS) & (F.col("triggered_at") > instant(as_of, timedelta(hours=hours)))
    )
    return decide(with_run_status(open_rows, ev)).select(
        "state_id", "current_stage", "run_status", "action", "next_stage", "next_status"
    )


def update_stage(st: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply one change per user to all of the user's in-progress rows.

    ``changes``: user_id (unique), stage, summarization_run_id and optionally
    status; NULL keeps the old value. The result is the whole new state table.
    """
    new = {"current_stage": "stage", "summarization_run_id": "summarization_run_id", "status": "status"}
    new = {column: source for column, source in new.items() if source in changes.columns}
    change = changes.select("user_id", *[F.col(source).alias(f"_{column}") for column, source in new.items()])
    is_open = F.col("status") == V.IN_PROGRESS
    return lookup(st, change, ["user_id"]).withColumns(
        {c: F.when(is_open, F.coalesce(f"_{c}", c)).otherwise(F.col(c)) for c in new}
    ).select(*STATE_COLUMNS)


def step_changes(decided: DataFrame, next_run: Column) -> DataFrame:
    """What a step of each user's pending workflow changes in the state table.

    ``decided`` has one row per user; ``next_run`` is the run id given to the
    summarization job that the step starts.
    """
    action = F.col("action")
    return decided.filter(action.isin("start_summarization", "upload", "clear")).select(
        "user_id",
        F.when(action != "clear", F.col("next_stage")).alias("stage"),
        F.when(action == "start_summarization", next_run).cast("long").alias("summarization_run_id"),
        F.when(action == "clear", V.WF_COMPLETED).alias("status"),
    )


def advance_state(
    st: DataFrame, ev: DataFrame, next_run: Column, as_of: datetime | None = None, hours: int = 2
) -> DataFrame:
    """The state table after every user's pending workflow took its next step."""
    pending = pending_workflow(st, as_of, hours).withColumn("status", F.lit(V.IN_PROGRESS))
    return update_stage(st, step_changes(decide(with_run_status(pending, ev)), next_run))


def clear_state(st: DataFrame, users: DataFrame) -> DataFrame:
    """Close the in-progress rows of the given users; the whole new state table."""
    marked = users.select("user_id").distinct().withColumn("_clear", F.lit(True))
    hit = (F.col("status") == V.IN_PROGRESS) & F.col("_clear")
    return lookup(st, marked, ["user_id"]).withColumn(
        "status", F.when(hit, V.WF_COMPLETED).otherwise(F.col("status"))
    ).select(*STATE_COLUMNS)
