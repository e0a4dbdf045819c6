"""Publishing of finished summaries: files, manifest and events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions.details import field
from vellumflow.functions.text import fill
from vellumflow.functions.times import compact_format, instant, iso_format
from vellumflow.operators.events import make_events
from vellumflow.operators.latest import newest_per
from vellumflow.operators.lineage import upload_outcomes
from vellumflow.operators.status import latest_of_agent
from vellumflow.session import scratch
from vellumflow.sources.files import write_text_files
from vellumflow.sources.store import TableStore


def render_summaries(su: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """File name and content of each summary (needs ``patient_id``)."""
    at = instant(as_of)
    content = F.concat_ws(
        "\n",
        F.lit(V.SUMMARY_RULE),
        F.concat(F.lit(V.SUMMARY_TITLE), F.col("patient_id")),
        F.lit(V.SUMMARY_RULE),
        F.concat(F.lit("Generated: "), iso_format(at)),
        F.concat(F.lit("Extraction Run ID: "), F.col("extraction_run_id").cast("string")),
        F.concat(F.lit("Summarization Run ID: "), F.col("summarization_run_id").cast("string")),
        F.lit(V.SUMMARY_RULE),
        F.lit(""),
        F.coalesce(F.col("summary_text"), F.lit("")),
    )
    name = F.concat(F.lit(V.SUMMARY_FILE_PREFIX), F.col("patient_id"), F.lit("_"), compact_format(at), F.lit(".txt"))
    return su.select("patient_id", name.alias("file_name"), content.alias("content"))


def upload_manifest(ev: DataFrame, su: DataFrame, site_url: str) -> DataFrame:
    """Outcome of publishing each summarization run known to the log.

    A run that did not complete is blocked and gives no event; a completed run
    without summary text fails. Only the presence of text is shuffled.
    """
    runs = latest_of_agent(ev, V.SUMMARIZATION, ["event_type", "triggered_by"])
    texts = newest_per(
        su.withColumn("has_text", F.coalesce(F.char_length("summary_text"), F.lit(0)) > 0),
        ["summarization_run_id"], "summarized_at", "summary_id", ["has_text"],
    ).withColumnRenamed("summarization_run_id", "run_id")
    done = F.col("event_type") == V.SUMMARIZATION.completed
    good = done & F.coalesce(F.col("has_text"), F.lit(False))
    url = F.concat(F.lit(f"{site_url}/Documents/summary_"), F.col("run_id").cast("string"), F.lit(".pdf"))
    return runs.join(texts, "run_id", "left").select(
        F.col("run_id").alias("summarization_run_id"),
        "triggered_by",
        F.when(good, url).alias("url"),
        F.when(good, V.UPLOAD.completed).when(done, V.UPLOAD.failed).alias("event_type"),
        F.when(~done, fill(V.MSG_NOT_COMPLETED, label=F.lit(V.SUMMARIZATION.label), run_id=F.col("run_id")))
        .when(~good, fill(V.MSG_NO_SUMMARY, run_id=F.col("run_id")))
        .alias("reason"),
    )


def upload_events(manifest: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Completed and failed events; they carry run id 0 and name their run in
    the details."""
    tried = manifest.filter(F.col("event_type").isNotNull()).select(
        "summarization_run_id", "triggered_by", F.col("url").alias("sharepoint_url"),
        F.col("reason").alias("error"), "event_type",
    )
    status = F.when(F.col("event_type") == V.UPLOAD.completed, "COMPLETED").otherwise("FAILED")
    return make_events(
        tried, F.col("event_type"), V.UPLOAD, status, as_of,
        ["summarization_run_id", "sharepoint_url", "error"],
        run_id=F.lit(V.NO_RUN).cast("long"),
    )


def storage_replies(stored: DataFrame, folder: str) -> DataFrame:
    """The outcome text of each stored file; ``error`` NULL means it was saved."""
    path = F.concat(F.lit(folder.rstrip("/") + "/"), F.col("file_name"))
    saved = fill(V.MSG_SAVED, name=F.col("file_name"), path=path)
    reply = F.when(F.col("error").isNull(), saved).otherwise(fill(V.MSG_NOT_SAVED, error=F.col("error")))
    return stored.select("file_name", reply.alias("message"))


def run_upload(spark: SparkSession, store: TableStore, folder: str, site_url: str, as_of: datetime) -> DataFrame:
    """Write the file of every publishable summary that is not yet uploaded and append
    the events; the manifest of these runs.

    Files come first: an event exists only for a file that was written. The
    patient id is the part of the document path after ``patient_``. The manifest is
    written once, so what follows does not see the events it adds.
    """
    ev, su = store.read("job_events"), store.read("summaries")
    uploaded = upload_outcomes(ev).filter(F.col("event_type") == V.UPLOAD.completed).select("summarization_run_id")
    path = scratch(spark, "manifest")
    upload_manifest(ev, su, site_url).join(uploaded, "summarization_run_id", "left_anti").write.parquet(path)
    manifest = spark.read.parquet(path)
    good = manifest.filter(F.col("event_type") == V.UPLOAD.completed).select("summarization_run_id")
    newest = newest_per(
        su, ["summarization_run_id"], "summarized_at", "summary_id",
        ["extraction_run_id", "summary_text", "document_metadata"],
    )
    source = field(F.col("document_metadata"), "document_path")
    patient = F.nullif(F.regexp_extract(source, r"patient_([^/.]+)", 1), F.lit(""))
    rows = newest.join(good, "summarization_run_id", "left_semi").withColumn(
        "patient_id", F.coalesce(patient, F.col("summarization_run_id").cast("string"))
    )
    write_text_files(render_summaries(rows, as_of), folder)
    store.append_new("job_events", upload_events(manifest, as_of))
    return manifest
