"""The workflow state rebuilt from the event log alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions.details import field
from vellumflow.functions.text import stable_id
from vellumflow.operators.joins import stand_in
from vellumflow.operators.lineage import upload_outcomes
from vellumflow.operators.workflow import STATE_COLUMNS


def workflow_state_from_events(ev: DataFrame) -> DataFrame:
    """One state row per extraction run.

    Extraction events and the summarization events that name their extraction
    run fold into one row per workflow in a single aggregation; uploads, which
    name only their summarization run, join that row.
    """
    extraction = (F.col("agent") == V.EXTRACTION.name) & (F.col("run_id") != V.NO_RUN)
    summarization = F.col("agent") == V.SUMMARIZATION.name
    source = F.when(extraction, F.col("run_id")).when(
        summarization, field(F.col("details"), "extraction_run_id", "long")
    )
    # Groups without an extraction event, among them those without a key, are
    # dropped after the aggregation: a filter on the key would parse the JSON
    # once more per row. Both agents' events compare by time, then id.
    rows = ev.filter(extraction | summarization).select(
        source.alias("workflow"),
        F.when(extraction, F.struct("timestamp", "event_id", "event_type", "triggered_by")).alias("e"),
        F.when(summarization, F.struct("timestamp", "event_id", "event_type", "run_id")).alias("s"),
        F.when(extraction, field(F.col("details"), "document_path")).alias("path"),
    )
    folded = (
        rows.groupBy("workflow")
        .agg(F.min("e").alias("first"), F.max("e").alias("last"), F.max("s").alias("s"), F.max("path").alias("document_path"))
        .select(
            "workflow", "document_path", "s",
            F.col("first.triggered_by").alias("user_id"),
            F.col("first.timestamp").alias("triggered_at"),
            F.col("last.event_type").alias("e"),
        )
    )
    uploads = upload_outcomes(ev).select("summarization_run_id", F.col("event_type").alias("u"))
    # Both sides have one row per run, so only missing runs could pile up.
    begun = folded.filter(F.col("e").isNotNull()).withColumn("run", stand_in(F.col("s.run_id"), "workflow"))
    state = begun.join(uploads.withColumnRenamed("summarization_run_id", "run"), "run", "left").withColumn(
        "summarization_run_id", F.col("s.run_id")
    )
    s_type = F.col("s.event_type")
    summarized = s_type == V.SUMMARIZATION.completed
    stage = (
        F.when(s_type.isNull(), V.EXTRACTING)
        .when(~summarized, V.SUMMARIZING)
        .when(F.col("u") == V.UPLOAD.completed, V.DONE)
        .otherwise(V.UPLOADING)
    )
    failed = (
        (s_type.isNull() & (F.col("e") == V.EXTRACTION.failed))
        | (s_type == V.SUMMARIZATION.failed)
        | (summarized & (F.col("u") == V.UPLOAD.failed))
    )
    return state.withColumn("extraction_run_id", F.col("workflow")).withColumns(
        {
            "state_id": stable_id(F.col("workflow")),
            "current_stage": stage,
            "status": F.when(F.coalesce(failed, F.lit(False)), V.WF_FAILED)
            .when(summarized & (F.col("u") == V.UPLOAD.completed), V.WF_COMPLETED)
            .otherwise(V.IN_PROGRESS),
        }
    ).select(*STATE_COLUMNS)
