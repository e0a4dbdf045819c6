"""Run status, progress and gates, for any number of runs at once."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions.text import fill
from vellumflow.functions.times import instant, view_minutes, whole_minutes
from vellumflow.operators.joins import lookup
from vellumflow.operators.latest import newest_per


def status_of(event_type: Column, agent: V.Agent) -> Column:
    """The event type decides; no event at all is NOT_FOUND."""
    return (
        F.when(event_type.isNull(), "NOT_FOUND")
        .when(event_type == agent.completed, "COMPLETED")
        .when(event_type == agent.failed, "FAILED")
        .otherwise("RUNNING")
    )


def latest_of_agent(ev: DataFrame, agent: V.Agent, columns: list[str]) -> DataFrame:
    """Newest event per run of one agent; run 0 stands for no run and is left out."""
    mine = ev.filter((F.col("agent") == agent.name) & (F.col("run_id") != V.NO_RUN))
    return newest_per(mine, ["run_id"], "timestamp", "event_id", columns)


def run_status(
    requested: DataFrame,
    ev: DataFrame,
    agent: V.Agent = V.EXTRACTION,
    budget_min: int | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Status, message and progress of each requested ``run_id`` (one row per run)."""
    budget = budget_min or agent.budget_minutes or 0
    newest = latest_of_agent(ev, agent, ["event_type", "details", "timestamp"])
    joined = requested.select("run_id").join(newest, "run_id", "left")
    status = status_of(F.col("event_type"), agent)
    elapsed = whole_minutes(instant(as_of), F.col("timestamp"))
    rows = joined.withColumns({"status": status}).withColumns(
        {"elapsed_min": F.when(F.col("status") == "RUNNING", elapsed)}
    ).withColumns(
        {"eta_min": F.when(F.col("status") == "RUNNING", F.greatest(F.lit(1), F.lit(budget) - F.col("elapsed_min")))}
    )
    message = (
        F.when(F.col("status") == "NOT_FOUND", fill(V.MSG_NOT_FOUND, job=F.lit(agent.job), run_id=F.col("run_id")))
        .when(F.col("status") == "COMPLETED", fill(V.MSG_JOB_COMPLETED, label=F.lit(agent.label)))
        .when(F.col("status") == "FAILED", fill(V.MSG_JOB_FAILED, label=F.lit(agent.label)))
        .otherwise(
            fill(V.MSG_JOB_RUNNING, label=F.lit(agent.label), elapsed=F.col("elapsed_min"), eta=F.col("eta_min"))
        )
    )
    return rows.select(
        "run_id",
        "status",
        message.alias("message"),
        F.when(F.col("status").isin("COMPLETED", "FAILED"), F.col("details")).alias("details"),
        F.when(F.col("status") == "COMPLETED", True).when(F.col("status") == "RUNNING", False).alias("ready"),
        "elapsed_min",
        "eta_min",
    )


def run_progress(requested: DataFrame, ev: DataFrame, agent: V.Agent = V.EXTRACTION, as_of: datetime | None = None) -> DataFrame:
    """Elapsed minutes and remaining estimate of the runs still going."""
    return run_status(requested, ev, agent, as_of=as_of).filter(F.col("status") == "RUNNING").select(
        "run_id", "elapsed_min", "eta_min"
    )


def completed_runs(ev: DataFrame, agent: V.Agent = V.EXTRACTION) -> DataFrame:
    """All runs whose newest event of the agent is its completion."""
    newest = latest_of_agent(ev, agent, ["event_type"])
    return newest.filter(F.col("event_type") == agent.completed).select("run_id")


def ready_runs(runs: DataFrame, ev: DataFrame, agent: V.Agent = V.EXTRACTION) -> DataFrame:
    """The given runs that are completed."""
    return runs.join(completed_runs(ev, agent), "run_id", "left_semi")


def blocked_runs(runs: DataFrame, ev: DataFrame, agent: V.Agent = V.EXTRACTION) -> DataFrame:
    """The runs the gate rejects, with their status and the reason."""
    newest = latest_of_agent(ev, agent, ["event_type"])
    status = status_of(F.col("event_type"), agent)
    return (
        runs.select("run_id")
        .join(newest, "run_id", "left")
        .filter(status != "COMPLETED")
        .select(
            "run_id",
            status.alias("status"),
            fill(V.MSG_NOT_COMPLETED, label=F.lit(agent.label), run_id=F.col("run_id")).alias("reason"),
        )
    )


def events_for_run(ev: DataFrame, requested: DataFrame) -> DataFrame:
    """All events of the requested (run_id, agent) pairs."""
    return lookup(ev, requested.select("run_id", "agent"), ["run_id", "agent"], "left_semi")


def audit_trail(ev: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """The history of the given users, in order of user and time; without users, that of
    all, ordered within each partition: a reader who wants one order names users."""
    shown = ["triggered_by", "timestamp", "event_type", "run_id", "agent", "sp_used", "status", "event_id"]
    order = ["triggered_by", "timestamp", "event_id"]
    if users is None:
        return ev.select(*shown).sortWithinPartitions(*order)
    wanted = users.select(F.col("user_id").alias("triggered_by"))
    return lookup(ev.select(*shown), wanted, ["triggered_by"], "left_semi").orderBy(*order)


def active_workflows(st: DataFrame, as_of: datetime | None = None, hours: int = 2) -> DataFrame:
    """In-progress workflows within the look-back, newest first."""
    return (
        st.filter((F.col("status") == V.IN_PROGRESS) & (F.col("triggered_at") > instant(as_of, timedelta(hours=hours))))
        .select(
            "user_id", "document_path", "extraction_run_id", "summarization_run_id", "current_stage", "triggered_at",
            view_minutes(instant(as_of), F.col("triggered_at")).alias("elapsed_minutes"),
        )
        .orderBy(F.col("triggered_at").desc())
    )


def user_active_jobs(hot: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Jobs of each user that are still pending or running."""
    jobs = hot.filter(F.col("status").isin(*V.ACTIVE_JOB_STATUSES))
    if users is not None:
        jobs = lookup(jobs, users.select("user_id"), ["user_id"], "left_semi")
    return jobs.select("user_id", "run_id", "status", "job_type", "updated_at")


def conversation_jobs(hot: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Jobs that belong to a conversation."""
    jobs = hot.filter(F.col("conversation_id").isNotNull())
    if conversations is not None:
        jobs = lookup(jobs, conversations.select("conversation_id"), ["conversation_id"], "left_semi")
    return jobs.select("conversation_id", "run_id", "user_id", "job_type", "status", "updated_at")
