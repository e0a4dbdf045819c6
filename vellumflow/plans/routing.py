"""Replies to a batch of chat messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions.text import (
    chat_choices, classify_intent, classify_refresh, document_path, fill, volume_path, volume_reply,
)
from vellumflow.functions.times import instant, whole_minutes
from vellumflow.operators.joins import lookup
from vellumflow.operators.latest import newest_per, pending_workflow
from vellumflow.operators.workflow import decide, with_run_status


def _job_message(agent: V.Agent, run: Column, at: datetime | None) -> Column:
    elapsed = whole_minutes(instant(at), F.col("event_at"))
    running = fill(
        V.MSG_JOB_RUNNING, label=F.lit(agent.label), elapsed=elapsed,
        eta=F.greatest(F.lit(1), F.lit(agent.budget_minutes) - elapsed),
    )
    label = F.lit(agent.label)
    return (
        F.when(F.col("run_status") == "NOT_FOUND", fill(V.MSG_NOT_FOUND, job=F.lit(agent.job), run_id=run))
        .when(F.col("run_status") == "COMPLETED", fill(V.MSG_JOB_COMPLETED, label=label))
        .when(F.col("run_status") == "FAILED", fill(V.MSG_JOB_FAILED, label=label))
        .otherwise(running)
    )


def step_reply(site_url: str, next_run: Column, as_of: datetime | None = None) -> Column:
    """The reply to a message that finds a workflow: what its step (columns of ``decide``) did."""
    extracting = F.col("current_stage") == V.EXTRACTING
    message = F.when(extracting, _job_message(V.EXTRACTION, F.col("extraction_run_id"), as_of)).otherwise(
        _job_message(V.SUMMARIZATION, F.col("summarization_run_id"), as_of)
    )
    url = F.concat(
        F.lit(f"{site_url}/Documents/summary_"), F.col("summarization_run_id").cast("string"), F.lit(".pdf")
    )
    action = F.col("action")
    label = F.when(extracting, V.EXTRACTION.label).otherwise(V.SUMMARIZATION.label)
    m = message
    return (
        F.when(
            action == "start_summarization",
            fill(V.MSG_TO_SUMMARY, message=m, run_id=next_run, eta=F.lit(V.SUMMARIZATION.budget_minutes)),
        )
        .when(action == "upload", fill(V.MSG_UPLOADED, url=url))
        .when((action == "clear") & (F.col("current_stage") == V.DONE), V.MSG_PREVIOUS_DONE)
        .when(action == "clear", fill(V.MSG_STAGE_FAILED, label=label, message=m))
        .when((action == "wait") & extracting, fill(V.MSG_EXTRACTING, message=m))
        .when(action == "wait", fill(V.MSG_SUMMARIZING, message=m))
        .otherwise(V.MSG_UNKNOWN_STATE)
    )


def workflow_replies(pending: DataFrame, ev: DataFrame, site_url: str, next_run: Column, as_of: datetime | None = None) -> DataFrame:
    """One reply per user with a pending workflow.

    ``next_run`` is the run id of the summarization job that the step starts.
    """
    decided = decide(with_run_status(pending.withColumn("status", F.lit(V.IN_PROGRESS)), ev))
    return decided.select("user_id", "action", step_reply(site_url, next_run, as_of).alias("reply"))


def route(
    messages: DataFrame, st: DataFrame, ev: DataFrame, site_url: str, new_run: Column, next_run: Column,
    as_of: datetime | None = None, hours: int = 2, knowledge: DataFrame | None = None,
) -> DataFrame:
    """Route and answer each message (event_id, user_id, content).

    A pending workflow of the user comes first, then the intent. ``new_run`` is
    the run id given to an extraction the message starts. ``knowledge`` holds
    ready search replies as (event_id, reply).
    """
    pending = pending_workflow(st, as_of, hours)
    answers = workflow_replies(pending, ev, site_url, next_run, as_of).select(
        "user_id", "action", F.col("reply").alias("workflow_reply")
    )
    content = F.col("content")
    asked = messages.withColumns({"intent": classify_intent(content), "path": document_path(content)})
    if knowledge is not None:
        asked = asked.join(knowledge.select("event_id", F.col("reply").alias("found")), "event_id", "left")
    else:
        asked = asked.withColumn("found", F.lit(None).cast("string"))
    joined = lookup(asked, answers, ["user_id"], spread_by="event_id")
    return answered(joined, new_run)


def answered(asked: DataFrame, new_run: Column) -> DataFrame:
    """Route and reply of messages with ``intent``, ``path``, ``found`` (a search reply) and
    ``workflow_reply``, which is null where the user has no workflow."""
    content = F.col("content")
    empty = content.isNull() | (content == "")
    started = fill(
        V.MSG_STARTED, path=F.col("path"), run_id=new_run, eta=F.lit(V.EXTRACTION.budget_minutes),
        next_steps=F.lit(V.MSG_NEXT_STEPS),
    )
    reply = (
        F.when(empty, V.MSG_EMPTY)
        .when(F.col("workflow_reply").isNotNull(), F.col("workflow_reply"))
        .when((F.col("intent") == "extract_document") & F.col("path").isNull(), V.MSG_NO_PATH)
        .when(F.col("intent") == "extract_document", started)
        .when(F.col("intent") == "check_status", V.MSG_NO_WORKFLOW)
        .when(F.col("intent") == "search_knowledge", F.coalesce(F.col("found"), F.lit(V.MSG_NO_KNOWLEDGE)))
        .otherwise(V.MSG_GENERAL)
    )
    kind = F.when(empty, "empty").when(F.col("workflow_reply").isNotNull(), "workflow").otherwise(F.col("intent"))
    return asked.select("event_id", "user_id", kind.alias("route"), "action", "path", reply.alias("reply"))


def route_volume(messages: DataFrame, new_run: Column) -> DataFrame:
    """The short form of routing: extract requests by volume path, else help."""
    content = F.col("content")
    path = volume_path(content)
    reply = (
        F.when(path.isNotNull(), fill(V.MSG_VOLUME_STARTED, path=path, run_id=new_run))
        .when(volume_reply(content).isNotNull(), volume_reply(content))
        .otherwise(V.MSG_VOLUME_HELP)
    )
    return messages.select("event_id", "user_id", path.alias("path"), reply.alias("reply"))


def route_catalog(messages: DataFrame, refresh_run: Column, products: DataFrame | None = None) -> DataFrame:
    """Catalog questions: a refresh request starts a job, anything else is a
    product search. ``products`` holds ready replies as (event_id, reply)."""
    content = F.col("content")
    target = classify_refresh(content)
    asked = messages.withColumn("target", target)
    if products is None:
        asked = asked.withColumn("found", F.lit(None).cast("string"))
    else:
        asked = asked.join(products.select("event_id", F.col("reply").alias("found")), "event_id", "left")
    reply = (
        F.when(F.coalesce(content, F.lit("")) == "", V.MSG_NO_QUESTION)
        .when(F.col("target") == "refresh", fill(V.MSG_REFRESH, run_id=refresh_run))
        .otherwise(F.coalesce(F.col("found"), F.lit(V.MSG_NO_PRODUCTS)))
    )
    return asked.select("event_id", "user_id", "target", reply.alias("reply"))


def chat_response(replies: DataFrame) -> DataFrame:
    """Chat response body and a content-derived id for each reply."""
    return replies.select(
        "event_id",
        chat_choices(F.col("reply")).alias("choices"),
        F.concat(F.lit("response-"), F.md5(F.concat_ws("|", F.col("event_id").cast("string"), "reply"))).alias("id"),
    )


def last_message(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """The last turn of each conversation; an empty text becomes the fixed reply."""
    last = newest_per(turns.withColumnRenamed("text", "content"), [key], order, "role", ["role", "content"])
    return last.withColumn("content", F.when(F.coalesce("content", F.lit("")) == "", V.MSG_EMPTY).otherwise(F.col("content")))
