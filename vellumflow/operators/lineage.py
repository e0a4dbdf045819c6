"""Document to extraction to summary to upload."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions.details import encode, field, ratio
from vellumflow.functions.text import page_count
from vellumflow.operators.joins import lookup
from vellumflow.operators.latest import newest_per
from vellumflow.operators.status import latest_of_agent, status_of


def upload_outcomes(ev: DataFrame) -> DataFrame:
    """Newest upload event of each summarization run, which uploads name only
    in their details (their own run id is 0)."""
    uploads = ev.filter(F.col("agent") == V.UPLOAD.name).withColumn(
        "summarization_run_id", field(F.col("details"), "summarization_run_id", "long")
    )
    return newest_per(
        uploads.filter(F.col("summarization_run_id") > V.NO_RUN),
        ["summarization_run_id"], "timestamp", "event_id", ["event_type", "timestamp"],
    )


def document_lineage(ex: DataFrame, su: DataFrame, ev: DataFrame) -> DataFrame:
    """Each extracted document with its run status, the newest summary of its
    run and the upload of that summary; NULL where a stage is absent.

    Every table joined to the documents has one row per key, so a run with many
    documents and many summaries never multiplies. Summary texts stay behind.
    """
    extraction = latest_of_agent(ev, V.EXTRACTION, ["event_type"]).select(
        F.col("run_id").alias("extraction_run_id"), F.col("event_type").alias("_e")
    )
    summarization = latest_of_agent(ev, V.SUMMARIZATION, ["event_type"]).select(
        F.col("run_id").alias("summarization_run_id"), F.col("event_type").alias("_s")
    )
    uploads = upload_outcomes(ev).select(
        "summarization_run_id", F.col("event_type").alias("_u"), F.col("timestamp").alias("uploaded_at")
    )
    summaries = newest_per(
        su, ["extraction_run_id"], "summarized_at", "summary_id",
        ["summary_id", "summarization_run_id", "summarized_at"],
    )
    # One row per run first; the wide side is joined once, last.
    fates = summarization.join(uploads, "summarization_run_id", "full_outer")
    chain = lookup(summaries, fates, ["summarization_run_id"])
    runs = extraction.join(chain, "extraction_run_id", "full_outer")
    documents = ex.select("extraction_id", "extraction_run_id", "document_path")
    return lookup(documents, runs, ["extraction_run_id"]).select(
        "extraction_id", "document_path", "extraction_run_id",
        F.when(F.col("_e").isNotNull(), status_of(F.col("_e"), V.EXTRACTION)).alias("extraction_status"),
        "summary_id", "summarization_run_id",
        F.when(F.col("_s").isNotNull(), status_of(F.col("_s"), V.SUMMARIZATION)).alias("summarization_status"),
        F.when(F.col("_u").isNotNull(), status_of(F.col("_u"), V.UPLOAD)).alias("upload_status"),
        "uploaded_at",
    )


def summary_metadata(ex: DataFrame, su: DataFrame, model: str | None = None) -> DataFrame:
    """Lengths, ratio and the metadata JSON of each summary against the newest
    extraction of its run. Only lengths cross the shuffle, not texts."""
    source = newest_per(
        ex.withColumn("original_length", F.char_length("extracted_text")),
        ["extraction_run_id"], "extracted_at", "extraction_id",
        ["document_path", "page_count", "original_length"],
    )
    lengths = su.select(
        "summary_id", "summarization_run_id", "extraction_run_id",
        F.char_length("summary_text").alias("summary_length"),
    )
    rows = lookup(lengths, source, ["extraction_run_id"]).withColumns(
        {
            "compression_ratio": ratio(F.col("original_length"), F.col("summary_length")),
            "summary_share": ratio(F.col("summary_length"), F.col("original_length")),
        }
    )
    metadata = encode(
        document_path=F.col("document_path"),
        extraction_run_id=F.col("extraction_run_id"),
        pages_summarized=F.col("page_count"),
        original_length=F.col("original_length"),
        summary_length=F.col("summary_length"),
        compression_ratio=F.col("compression_ratio"),
        model_used=F.lit(model),
    )
    return rows.select(
        "summary_id", "summarization_run_id", "original_length", "summary_length",
        "compression_ratio", "summary_share", metadata.alias("document_metadata"),
    )


def document_stats(ex: DataFrame, breaks: dict[str, str] | None = None) -> DataFrame:
    """Characters of each text and its parts by each named break, in one pass."""
    text = F.col("extracted_text")
    parts = {"page_count": V.PAGE_BREAK} if breaks is None else breaks
    return ex.select(
        "extraction_id",
        F.char_length(text).alias("n_chars"),
        *[page_count(text, mark).alias(name) for name, mark in parts.items()],
    )
