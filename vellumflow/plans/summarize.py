"""Summaries of extracted documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vellumflow import vocabulary as V
from vellumflow.functions.details import encode, ratio
from vellumflow.functions.text import compose_id, leading_sentences
from vellumflow.functions.times import instant
from vellumflow.operators.events import make_events
from vellumflow.operators.latest import latest_extraction
from vellumflow.operators.status import completed_runs
from vellumflow.session import scratch
from vellumflow.sources.store import TableStore

Summarizer = Callable[[str], str]
DEFAULT_MODEL = "leading_sentences"


def with_summary(rows: DataFrame, load: Callable[[], Summarizer] | None = None, sentences: int = 3) -> DataFrame:
    """Add summary_text and error to rows with ``extracted_text``.

    ``load`` builds the caller's model once per task; a text it fails on gets
    the error instead of a summary. Without a model the leading sentences stand
    in, as a native expression.
    """
    if load is None:
        return rows.withColumns(
            {
                "summary_text": leading_sentences(F.col("extracted_text"), sentences),
                "error": F.lit(None).cast("string"),
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def attempt(text: str) -> tuple[str | None, str | None]:
            try:
                return model(text), None
            except Exception as e:  # the error is the row's result
                return None, str(e)

        for pdf in batches:
            done = [attempt(t) for t in pdf["extracted_text"]]
            yield pdf.assign(
                summary_text=pd.Series([d[0] for d in done], index=pdf.index, dtype=object),
                error=pd.Series([d[1] for d in done], index=pdf.index, dtype=object),
            )

    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("summary_text string, error string").fields])
    return rows.mapInPandas(run, schema)


def summarize(ex: DataFrame, load: Callable[[], Summarizer] | None = None, sentences: int = 3) -> DataFrame:
    """(extraction_id, summary_text, error) of each text."""
    rows = ex.select("extraction_id", "extracted_text")
    return with_summary(rows, load, sentences).select("extraction_id", "summary_text", "error")


def ready_extractions(ev: DataFrame, ex: DataFrame) -> DataFrame:
    """The newest extraction of every run that passed the extraction gate."""
    ready = completed_runs(ev, V.EXTRACTION).select(F.col("run_id").alias("extraction_run_id"))
    return latest_extraction(ex, ready).filter("found").drop("found")


def summary_rows(summarized: DataFrame, as_of: datetime | None = None, model: str = DEFAULT_MODEL) -> DataFrame:
    """Rows of the summary table; empty summaries have a NULL ratio."""
    original, short = F.char_length("extracted_text"), F.char_length("summary_text")
    metadata = encode(
        document_path=F.col("document_path"),
        extraction_run_id=F.col("extraction_run_id"),
        pages_summarized=F.col("page_count"),
        original_length=original,
        summary_length=short,
        compression_ratio=ratio(original, short),
        model_used=F.lit(model),
    )
    return summarized.filter(F.col("error").isNull()).select(
        compose_id("summary_", F.col("summarization_run_id")).alias("summary_id"),
        "summarization_run_id",
        "extraction_run_id",
        "summary_text",
        metadata.alias("document_metadata"),
        instant(as_of).alias("summarized_at"),
        F.lit(V.SUMMARIZATION.principal).alias("summarized_by"),
    )


def summarize_ready(
    ev: DataFrame, ex: DataFrame, summarization_run: Column, as_of: datetime | None = None,
    sentences: int = 3, model: str = DEFAULT_MODEL,
) -> DataFrame:
    """Native summary rows for every run that passed the extraction gate."""
    ready = ready_extractions(ev, ex).withColumn("summarization_run_id", summarization_run)
    return summary_rows(with_summary(ready, None, sentences), as_of, model)


def completion_events(su: DataFrame, triggered_by: Column, as_of: datetime | None = None, model: str = DEFAULT_MODEL) -> DataFrame:
    """One completion event per stored summary."""
    facts = su.select(
        F.col("summarization_run_id").alias("run_id"),
        triggered_by.alias("triggered_by"),
        "extraction_run_id",
        F.char_length("summary_text").alias("summary_length"),
        F.get_json_object("document_metadata", "$.compression_ratio").cast("double").alias("compression_ratio"),
        F.lit(model).alias("model_used"),
        "summary_id",
    )
    return make_events(
        facts, V.SUMMARIZATION.completed, V.SUMMARIZATION, "SUCCESS", as_of,
        ["extraction_run_id", "summary_length", "compression_ratio", "model_used", "summary_id"],
    )


def failure_events(summarized: DataFrame, triggered_by: Column, as_of: datetime | None = None) -> DataFrame:
    """One failure event per text the model could not summarize."""
    failed = summarized.filter(F.col("error").isNotNull()).select(
        F.col("summarization_run_id").alias("run_id"),
        triggered_by.alias("triggered_by"),
        "extraction_run_id",
        "error",
    )
    return make_events(failed, V.SUMMARIZATION.failed, V.SUMMARIZATION, "FAILED", as_of, ["extraction_run_id", "error"])


def run_summarize(
    spark: SparkSession, store: TableStore, summarization_run: Column, triggered_by: Column, as_of: datetime,
    load: Callable[[], Summarizer] | None = None, model: str = DEFAULT_MODEL,
) -> DataFrame:
    """Summarize every ready run that has no summary yet and append summaries and events.

    Model calls are costly and may not repeat: extractions that are summarized leave
    before their text is read, and results are written to the shared work folder
    once; both tables are filled from there.
    """
    extracted = store.read("extracted_documents")
    if store.exists("summaries"):
        extracted = extracted.join(store.read("summaries").select("extraction_run_id").distinct(), "extraction_run_id", "left_anti")
    ready = ready_extractions(store.read("job_events"), extracted)
    path = scratch(spark, "summarized")
    with_summary(ready.withColumn("summarization_run_id", summarization_run), load).write.parquet(path)
    summarized = spark.read.parquet(path)
    su = summary_rows(summarized, as_of, model)
    store.append_new("summaries", su)
    done = completion_events(su, triggered_by, as_of, model)
    store.append_new("job_events", done.unionByName(failure_events(summarized, triggered_by, as_of)))
    return summarized
