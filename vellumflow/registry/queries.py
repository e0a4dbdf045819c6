"""Every operator as a named query over one directory of raw parquet."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions import details as D
from vellumflow.functions import text as X
from vellumflow.operators import (
    events, governance, latest, limits, lineage, metrics, search, sequences, sketches, status, terms, tiers, vector_index, workflow,
)
from vellumflow.plans import extract, ordered, projection, routing, summarize, upload
from vellumflow.session import scratch
from vellumflow.sources import feed, files, store as store_of
from vellumflow.sources.derived import Derived
from vellumflow.sources.store import TableStore
from vellumflow.streaming import changes, folds, streams, timers

AS_OF = datetime(2024, 1, 31)
WHOLE_LOG_HOURS = 31 * 24
WEEK_HOURS = 7 * 24
SITE = "https://example.test/site"
BLOCKED = ("license", "copyright", "confidential", "the ")
NTZ = "timestamp_ntz"

# Executors need not have this package: the model function travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Derived], DataFrame]) -> Callable[[Derived], DataFrame]:
    """Register ``build`` under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Derived(spark, sf_dir))
    return build


def _extraction_runs(t: Derived) -> DataFrame:
    return t.conversation_state().select(F.col("extraction_run_id").alias("run_id"))


def _document_runs(t: Derived) -> DataFrame:
    return t.extracted_documents().select(F.col("extraction_run_id").alias("run_id")).distinct()


def _summary_runs(t: Derived) -> DataFrame:
    return t.summaries().select(F.col("summarization_run_id").alias("run_id")).distinct()


# --- sources ---------------------------------------------------------------


def _text_folder(t: Derived) -> str:
    rendered = t.raw("documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
        F.col("text").alias("content"),
    )
    return files.write_text_files(rendered, scratch(t.spark, "documents"))


@query
def read_documents(t: Derived) -> DataFrame:
    docs = files.read_documents(t.spark, _text_folder(t))
    return docs.select(
        F.regexp_extract("document_path", r"file_name=([^/]+)/", 1).alias("file_name"), "extracted_text"
    )


@query
def list_summaries(t: Derived) -> DataFrame:
    rendered = upload.render_summaries(_patients(t), AS_OF)
    folder = files.write_text_files(rendered, scratch(t.spark, "summaries"))
    return files.list_summaries(t.spark, folder).select("file_name", "size")


@query
def get_summary(t: Derived) -> DataFrame:
    wanted = t.raw("customer").select(
        F.concat(F.lit("doc_"), F.col("c_custkey").cast("string"), F.lit(".txt")).alias("file_name")
    )
    return files.get_summaries(files.read_documents(t.spark, _text_folder(t)), wanted)


@query
def last_message(t: Derived) -> DataFrame:
    return routing.last_message(t.raw("conversations"))


@query
def hot_lookup(t: Derived) -> DataFrame:
    return tiers.hot_lookup(_extraction_runs(t), t.job_status())


# --- new rows and table changes ---------------------------------------------


@query
def append_events(t: Derived) -> DataFrame:
    runs = t.conversation_state().select(
        F.col("extraction_run_id").alias("run_id"), F.col("user_id").alias("triggered_by"), "document_path"
    )
    return events.make_events(runs, V.EXTRACTION.started, V.EXTRACTION, "RUNNING", AS_OF, ["document_path"])


@query
def store_workflow_state(t: Derived) -> DataFrame:
    requests = t.messages().select(
        "user_id",
        X.document_path(F.col("content")).alias("document_path"),
        (F.col("event_id") * 10 + 1).alias("extraction_run_id"),
    )
    return events.new_workflows(requests.filter(F.col("document_path").isNotNull()), AS_OF)


@query
def update_workflow_stage(t: Derived) -> DataFrame:
    st = t.conversation_state()
    pending = latest.pending_workflow(st, AS_OF, WHOLE_LOG_HOURS)
    first = F.col("current_stage") == V.EXTRACTING
    changes_ = pending.select(
        "user_id",
        F.when(first, V.SUMMARIZING).otherwise(V.DONE).alias("stage"),
        F.when(first, F.col("extraction_run_id") + 1).alias("summarization_run_id"),
    )
    return workflow.update_stage(st, changes_)


@query
def clear_workflow_state(t: Derived) -> DataFrame:
    st = t.conversation_state()
    steps = workflow.decide(workflow.with_run_status(st.filter(F.col("status") == V.IN_PROGRESS), t.job_events()))
    return workflow.clear_state(st, steps.filter(F.col("action") == "clear"))


def _patients(t: Derived) -> DataFrame:
    return t.summaries().withColumn("patient_id", F.regexp_replace("summary_id", "^summary_", ""))


@query
def summary_files(t: Derived) -> DataFrame:
    return upload.render_summaries(_patients(t), AS_OF)


@query
def storage_replies(t: Derived) -> DataFrame:
    error = F.when(F.char_length("content") > 500, "file too large")
    rendered = upload.render_summaries(_patients(t), AS_OF).withColumn("error", error)
    return upload.storage_replies(rendered, "/summaries")


@query
def upload_manifest(t: Derived) -> DataFrame:
    return upload.upload_manifest(t.job_events(), t.summaries(), SITE)


@query
def archive_old_jobs(t: Derived) -> DataFrame:
    archived, kept = tiers.split_archive(t.job_status(), AS_OF, days=7)
    return archived.withColumn("part", F.lit("archived")).unionByName(kept.withColumn("part", F.lit("kept")))


# --- projections and filters ---------------------------------------------------


@query
def audit_tail(t: Derived) -> DataFrame:
    return latest.audit_tail(t.job_events())


@query
def extraction_preview(t: Derived) -> DataFrame:
    return latest.extraction_preview(t.extracted_documents())


@query
def events_for_run(t: Derived) -> DataFrame:
    wanted = _extraction_runs(t).withColumn("agent", F.lit(V.EXTRACTION.name))
    return status.events_for_run(t.job_events(), wanted)


@query
def audit_trail(t: Derived) -> DataFrame:
    return status.audit_trail(t.job_events())


@query
def active_workflows(t: Derived) -> DataFrame:
    return status.active_workflows(t.conversation_state(), AS_OF, WEEK_HOURS)


@query
def user_active_jobs(t: Derived) -> DataFrame:
    return status.user_active_jobs(t.job_status())


@query
def conversation_jobs(t: Derived) -> DataFrame:
    return status.conversation_jobs(t.job_status())


@query
def validate_document_path(t: Derived) -> DataFrame:
    content = F.col("content")
    asked = t.messages().select(
        "event_id", F.coalesce(X.document_path(content), X.volume_path(content)).alias("document_path")
    )
    return governance.validate_paths(asked.filter(F.col("document_path").isNotNull()))


@query
def validate_required(t: Derived) -> DataFrame:
    checked = governance.validate_required(
        t.job_status(),
        {
            "user_id": "user is required",
            "conversation_id": "conversation is required",
            "sp_used": "principal is still a placeholder",
        },
        placeholders=("SHAREPOINT",),
    )
    return checked.select("run_id", F.array_join("errors", "; ").alias("errors"))


# --- status, gates, state machine -------------------------------------------------


@query
def job_status_latest(t: Derived) -> DataFrame:
    return latest.job_status_latest(t.job_events())


@query
def latest_event_per_run_agent(t: Derived) -> DataFrame:
    return latest.latest_event(t.linked_events())


@query
def run_status(t: Derived) -> DataFrame:
    return status.run_status(_extraction_runs(t), t.job_events(), V.EXTRACTION, as_of=AS_OF)


@query
def run_progress(t: Derived) -> DataFrame:
    return status.run_progress(_summary_runs(t), t.job_events(), V.SUMMARIZATION, AS_OF)


@query
def ready_for_summarization(t: Derived) -> DataFrame:
    return status.ready_runs(_document_runs(t), t.job_events(), V.EXTRACTION)


@query
def ready_for_upload(t: Derived) -> DataFrame:
    return status.ready_runs(_summary_runs(t), t.job_events(), V.SUMMARIZATION)


@query
def blocked_runs(t: Derived) -> DataFrame:
    return status.blocked_runs(_document_runs(t), t.job_events(), V.EXTRACTION)


@query
def pending_workflow(t: Derived) -> DataFrame:
    return latest.pending_workflow(t.conversation_state(), AS_OF, WEEK_HOURS)


@query
def workflow_advance(t: Derived) -> DataFrame:
    return workflow.advance(t.conversation_state(), t.job_events(), AS_OF, WHOLE_LOG_HOURS)


@query
def advance_state(t: Derived) -> DataFrame:
    return workflow.advance_state(
        t.conversation_state(), t.job_events(), F.col("extraction_run_id") + 1, AS_OF, WHOLE_LOG_HOURS
    )


@query
def workflow_state_from_events(t: Derived) -> DataFrame:
    return projection.workflow_state_from_events(t.linked_events())


# --- tiers ---------------------------------------------------------------------------


@query
def job_status_lookup(t: Derived) -> DataFrame:
    return tiers.lookup_status(_extraction_runs(t), t.job_status(), t.job_events())


@query
def hot_upsert(t: Derived) -> DataFrame:
    store = t.job_status()
    changes_ = (
        store.filter(F.col("agent") != V.UPLOAD.name)
        .withColumns(
            {
                "status": F.lit("SUCCESS"),
                "conversation_id": F.lit(None).cast("string"),
                "created_at": F.col("updated_at"),
                "updated_at": F.lit("2024-01-31 00:00:00").cast(NTZ),
            }
        )
    )
    late = store.withColumns({"status": F.lit("PENDING"), "updated_at": F.col("created_at") - F.expr("INTERVAL 1 DAY")})
    return tiers.upsert_status(store, changes_.unionByName(late))


@query
def hot_delete(t: Derived) -> DataFrame:
    finished, _ = tiers.split_archive(t.job_status(), AS_OF, days=7)
    return tiers.delete_status(t.job_status(), finished)


@query
def unified_status(t: Derived) -> DataFrame:
    return tiers.unified_status(t.job_status(), t.job_events())


@query
def tier_drift(t: Derived) -> DataFrame:
    # A hot tier that has drifted: summarization runs changed, runs that the log never saw.
    hot = t.job_status()
    changed = hot.withColumn("status", F.when(F.col("agent") == V.SUMMARIZATION.name, "CANCELLED").otherwise(F.col("status")))
    unseen = hot.filter(F.col("agent") == V.UPLOAD.name).withColumns(
        {"run_id": F.concat(F.lit("9"), "run_id", F.lit("0")), "status": F.lit("PENDING")}
    )
    return tiers.tier_drift(changed.unionByName(unseen), t.job_events())


@query
def recent_checkpoints(t: Derived) -> DataFrame:
    return latest.recent_checkpoints(t.checkpoints())


# --- documents and summaries ---------------------------------------------------------


@query
def latest_summary(t: Derived) -> DataFrame:
    return latest.latest_summary(t.summaries())


@query
def summary_for_run(t: Derived) -> DataFrame:
    return latest.summary_for_run(t.conversation_state(), t.summaries())


@query
def extraction_for_run(t: Derived) -> DataFrame:
    return latest.latest_extraction(t.extracted_documents(), t.conversation_state())


@query
def document_lineage(t: Derived) -> DataFrame:
    return lineage.document_lineage(t.extracted_documents(), t.summaries(), t.linked_events())


@query
def recent_events(t: Derived) -> DataFrame:
    return latest.recent_events(t.job_events())


@query
def recent_extractions(t: Derived) -> DataFrame:
    return latest.recent_extractions(t.extracted_documents())


@query
def document_stats(t: Derived) -> DataFrame:
    return lineage.document_stats(t.extracted_documents(), {"page_count": V.PAGE_BREAK, "line_count": "\n"})


@query
def compression_ratio(t: Derived) -> DataFrame:
    return lineage.summary_metadata(t.extracted_documents(), t.summaries()).select(
        "summary_id", "original_length", "summary_length", "compression_ratio", "summary_share"
    )


@query
def summary_metadata(t: Derived) -> DataFrame:
    return lineage.summary_metadata(t.extracted_documents(), t.summaries(), "model-a").select(
        "summary_id", "summarization_run_id", "document_metadata"
    )


@query
def summarize_documents(t: Derived) -> DataFrame:
    return summarize.summarize(t.extracted_documents())


# --- search -----------------------------------------------------------------------------


@query
def knowledge_topk(t: Derived) -> DataFrame:
    return search.knowledge_topk(t.knowledge(), search.label_centroids(t.raw("embeddings")))


@query
def knowledge_reply(t: Derived) -> DataFrame:
    return search.knowledge_replies(knowledge_topk(t))


@query
def product_topk(t: Derived) -> DataFrame:
    return search.product_topk(t.products(), search.label_centroids(t.raw("embeddings")))


def _every_fiftieth(t: Derived) -> DataFrame:
    """The query set of the index: embeddings with an id divisible by 50, against all."""
    return t.raw("embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query
def indexed_topk(t: Derived) -> DataFrame:
    index = vector_index.build(t.raw("embeddings"), scratch(t.spark, "vectors"))
    queries = _every_fiftieth(t)
    return vector_index.search(index, queries, probes=vector_index.probes_for(index, queries))


@query
def indexed_topk_exact(t: Derived) -> DataFrame:
    return vector_index.search_exact(vector_index.build(t.raw("embeddings"), scratch(t.spark, "vectors")), _every_fiftieth(t))


@query
def product_lines(t: Derived) -> DataFrame:
    return t.raw("part").select("p_partkey", search.product_line("p_name", "p_type", "p_retailprice").alias("line"))


# --- metrics ---------------------------------------------------------------------------


@query
def request_volume(t: Derived) -> DataFrame:
    return metrics.request_volume(t.job_events())


@query
def latency_percentiles(t: Derived) -> DataFrame:
    return metrics.latency_percentiles(t.agent_usage())


@query
def error_rates(t: Derived) -> DataFrame:
    return metrics.error_rates(t.job_events())


@query
def cost_per_request(t: Derived) -> DataFrame:
    costs = metrics.cost_per_request(t.agent_usage())
    return costs.withColumn("total_cost", F.col("total_cost").cast("double"))


@query
def documents_processed(t: Derived) -> DataFrame:
    return metrics.documents_processed(t.job_events())


@query
def top_queries(t: Derived) -> DataFrame:
    return metrics.top_queries(t.messages())


@query
def security_events(t: Derived) -> DataFrame:
    return metrics.security_events(t.job_events())


@query
def budget_alerts(t: Derived) -> DataFrame:
    return metrics.budget_alerts(t.agent_usage(), 20.0).withColumn("cost", F.col("cost").cast("double"))


@query
def rate_limit_violations(t: Derived) -> DataFrame:
    return metrics.rate_limit_violations(t.messages(), limit=1, window="1 hour")


@query
def stage_durations(t: Derived) -> DataFrame:
    return sequences.stage_durations(t.linked_events())


@query
def event_gaps(t: Derived) -> DataFrame:
    return sequences.event_gaps(t.job_events())


@query
def stalled_runs(t: Derived) -> DataFrame:
    return sequences.stalled_runs(t.job_events(), AS_OF)


# --- governance -------------------------------------------------------------------------


@query
def key_violations(t: Derived) -> DataFrame:
    su, ex = t.summaries(), t.extracted_documents()
    return governance.key_violations(
        {
            "job_events": (t.job_events(), "event_id"),
            "conversation_state": (t.conversation_state(), "state_id"),
            "extracted_documents": (ex, "extraction_id"),
            "extracted_documents by run": (ex, "extraction_run_id"),
            "summaries": (su, "summary_id"),
            "summaries appended twice": (su.unionByName(su), "summary_id"),
            "job_status": (t.job_status(), "run_id"),
            "job_status by conversation": (t.job_status(), "conversation_id"),
        }
    )


@query
def principal_isolation(t: Derived) -> DataFrame:
    return governance.principal_isolation(t.job_events(), {V.EXTRACTION.name: "EXTRACTION_SP", V.SUMMARIZATION.name: "OTHER_SP"})


@query
def active_prompt(t: Derived) -> DataFrame:
    return latest.active_prompt(t.prompts())


@query
def pii_detect(t: Derived) -> DataFrame:
    return governance.pii_detect(t.raw("documents")).select("doc_id", *[f"{n}_count" for n in V.PII_PATTERNS])


@query
def pii_redact(t: Derived) -> DataFrame:
    return t.raw("documents").select("doc_id", governance.redacted(F.col("text")).alias("text"))


@query
def input_limits(t: Derived) -> DataFrame:
    checked = governance.input_limits(t.raw("documents"), "text", "lang", 5000, ("en", "de"), 6000)
    return checked.select("doc_id", F.array_join("reasons", "; ").alias("reasons"))


@query
def blocked_terms(t: Derived) -> DataFrame:
    return governance.blocked_terms(t.raw("documents"), "doc_id", "text", BLOCKED)


# --- column functions ------------------------------------------------------------------


@query
def classify_intent(t: Derived) -> DataFrame:
    return t.messages().select("event_id", X.classify_intent(F.col("content")).alias("intent"))


@query
def classify_refresh(t: Derived) -> DataFrame:
    return t.messages().select("event_id", X.classify_refresh(F.col("content")).alias("target"))


@query
def extract_document_path(t: Derived) -> DataFrame:
    return t.messages().select("event_id", X.document_path(F.col("content")).alias("document_path"))


@query
def extract_volume_path(t: Derived) -> DataFrame:
    content = F.col("content")
    return t.messages().select(
        "event_id", X.volume_path(content).alias("volume_path"), X.volume_reply(content).alias("reply")
    )


@query
def parse_run_id(t: Derived) -> DataFrame:
    run = F.col("run_id").cast("string")
    text = (
        F.when(F.col("status") == "FAILED", "no run")
        .when(F.col("run_id") % 2 == 0, F.concat(F.lit("RunId("), run, F.lit(")")))
        .otherwise(run)
    )
    return t.job_events().select("event_id", X.parse_run_id(text).alias("parsed_run_id"))


@query
def event_details(t: Derived) -> DataFrame:
    error = F.when(F.col("status") == "FAILED", F.concat(F.lit("failed with "), D.field(F.col("details"), "k")))
    return t.job_events().select(
        "event_id", D.encode(run_id=F.col("run_id"), sp_used=F.col("sp_used"), error=error).alias("details")
    )


@query
def details_fields(t: Derived) -> DataFrame:
    return t.job_events().select(
        "event_id",
        D.field(F.col("details"), "k", "int").alias("k"),
        D.field(F.col("details"), "document_path").alias("document_path"),
    )


@query
def build_prompt(t: Derived) -> DataFrame:
    prompt = t.extracted_documents().select("extraction_id", X.build_prompt(F.col("extracted_text")).alias("m"))
    return prompt.select(
        "extraction_id",
        F.col("m")[0]["role"].alias("first_role"),
        F.col("m")[0]["content"].alias("instruction"),
        F.col("m")[1]["role"].alias("second_role"),
        F.col("m")[1]["content"].alias("request"),
    )


@query
def text_helpers(t: Derived) -> DataFrame:
    content = F.col("content")
    address = F.concat(F.lit("user"), F.col("user_id"), F.lit("@example.test"))
    return t.messages().select(
        "event_id",
        X.preview(content, 20).alias("preview"),
        X.sql_quoted(content).alias("quoted"),
        X.compose_id("extract_", F.col("event_id")).alias("composed_id"),
        X.user_of_address(address).alias("user_name"),
        F.date_format("ts", "yyyyMMdd_HHmmss").alias("stamp"),
        F.col("ts").cast("string").try_cast(NTZ).alias("parsed_ts"),
    )


# --- chat ----------------------------------------------------------------------------------


@query
def route_messages(t: Derived) -> DataFrame:
    return routing.route(
        t.messages(), t.conversation_state(), t.job_events(), SITE,
        new_run=F.col("event_id") * 10 + 1, next_run=F.col("extraction_run_id") + 1,
        as_of=AS_OF, hours=WEEK_HOURS,
    )


@query
def route_in_order(t: Derived) -> DataFrame:
    asked = t.message_vectors().where(X.classify_intent(F.col("content")) == "search_knowledge")
    found = search.knowledge_replies(search.knowledge_topk(t.knowledge(), asked)).withColumnRenamed("query_id", "event_id")
    return ordered.route_in_order(
        t.messages(), t.conversation_state(), t.job_events(), SITE,
        new_run=F.col("event_id") * 10 + 1, next_run=F.col("extraction_run_id") + 1,
        as_of=AS_OF, hours=WEEK_HOURS, knowledge=found,
    )


@query
def catalog_replies(t: Derived) -> DataFrame:
    asked = t.message_vectors().where(X.classify_refresh(F.col("content")) == "search")
    found = search.product_replies(search.product_topk(t.product_pages(), asked)).withColumnRenamed("query_id", "event_id")
    return routing.route_catalog(t.messages(), F.col("event_id") * 10 + 9, found)


@query
def chat_response(t: Derived) -> DataFrame:
    responses = routing.chat_response(route_messages(t))
    one = F.col("choices")[0]
    return responses.select(
        "event_id", "id",
        F.size("choices").alias("n_choices"),
        one["index"].alias("choice_index"),
        one["message"]["role"].alias("role"),
        one["message"]["content"].alias("content"),
        one["finish_reason"].alias("finish_reason"),
    )


@query
def route_volume(t: Derived) -> DataFrame:
    return routing.route_volume(t.messages(), F.col("event_id") * 10 + 1)


@query
def route_catalog(t: Derived) -> DataFrame:
    return routing.route_catalog(t.messages(), F.col("event_id") * 10 + 9)


# --- whole batches ------------------------------------------------------------------------


@query
def extract_batch(t: Derived) -> DataFrame:
    docs = t.raw("documents").select(
        (F.col("doc_id") * 10 + 1).alias("extraction_run_id"),
        F.concat(F.lit("/source_pdfs/patient_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("document_path"),
        F.col("text").alias("extracted_text"),
    )
    staged = extract.extract(docs, AS_OF, "\n").staged
    return extract.completion_events(staged, F.lit("batch"), AS_OF)


@query
def summarize_batch(t: Derived) -> DataFrame:
    return summarize.summarize_ready(
        t.job_events(), t.extracted_documents(), F.col("extraction_run_id") + 1, AS_OF
    )


@query
def upload_batch(t: Derived) -> DataFrame:
    return upload.upload_events(upload.upload_manifest(t.job_events(), t.summaries(), SITE), AS_OF)


# --- limits over any interval, change feed -------------------------------------------------


@query
def request_bursts(t: Derived) -> DataFrame:
    return limits.bursts(t.messages(), "user_id", "ts", "event_id", limit=2, seconds=6 * 3600)


@query
def budget_by_user(t: Derived) -> DataFrame:
    over = limits.over_budget(t.agent_usage(), "user_id", "timestamp", "invocation_id", "cost", budget=0.5, seconds=24 * 3600)
    return over.withColumn("spent", F.col("spent").cast("double"))


@query
def budget_by_agent(t: Derived) -> DataFrame:
    over = limits.over_budget(t.agent_usage(), "agent_id", "timestamp", "invocation_id", "cost", budget=5.0, seconds=6 * 3600)
    return over.withColumn("spent", F.col("spent").cast("double"))


@query
def latency_by_hour(t: Derived) -> DataFrame:
    target = scratch(t.spark, "latency")
    usage = Derived.as_agent_usage(streams.event_stream(t.spark, t.root, t.raw("events").schema, "events.parquet"))
    sketches.keep(usage, "agent_id", "timestamp", "latency_ms", target, f"{target}/checkpoint").awaitTermination()
    return sketches.over_time(sketches.kept(t.spark, target), "agent_id")


@query
def listed_terms(t: Derived) -> DataFrame:
    words = t.raw("benchmark").select(F.explode(F.split("text", " ")).alias("term"))
    return terms.term_matches(t.raw("documents"), "doc_id", "text", words.where("char_length(term) >= 6"))


def _state_changes(t: Derived) -> DataFrame:
    st = t.conversation_state()
    after = workflow.advance_state(st, t.job_events(), F.col("extraction_run_id") + 1, AS_OF, WHOLE_LOG_HOURS)
    return feed.table_changes(st, after.where("status <> 'completed' OR current_stage <> 'completed'"), ["state_id"], 1)


@query
def table_changes(t: Derived) -> DataFrame:
    return _state_changes(t)


@query
def replayed_changes(t: Derived) -> DataFrame:
    st = t.conversation_state()
    log = feed.ChangeFeed(t.spark, scratch(t.spark, "feed"), st.schema)
    for _ in range(2):  # a repeated job replaces its version
        log.write(_state_changes(t))
    return feed.replay(st, log.read(since=1), ["state_id"])


# --- the table store and whole jobs, each run twice ------------------------------------------


def _store(t: Derived, by_run: bool = False, **tables: DataFrame) -> TableStore:
    store = TableStore(t.spark, scratch(t.spark, "tables"), by_run)
    for name, rows in tables.items():
        store.append_new(name, rows)
        store.append_new(name, rows)
    return store


@query
def table_roundtrip(t: Derived) -> DataFrame:
    return _store(t, job_events=t.job_events()).read("job_events").withColumn("timestamp", F.col("timestamp").cast(NTZ))


@query
def named_table(t: Derived) -> DataFrame:
    _store(t, summaries=t.summaries()).register("summaries")
    return store_of.named_table(t.spark, "summaries").withColumn("summarized_at", F.col("summarized_at").cast(NTZ))


@query
def run_status_by_run(t: Derived) -> DataFrame:
    requested = _extraction_runs(t)
    return status.run_status(requested, _store(t, by_run=True, job_events=t.job_events()).read_runs("job_events", requested), as_of=AS_OF)


@query
def summary_by_run(t: Derived) -> DataFrame:
    requested = _summary_runs(t).withColumnRenamed("run_id", "summarization_run_id")
    return latest.summary_for_run(requested, _store(t, by_run=True, summaries=t.summaries()).read_runs("summaries", requested))


@query
def rows_to_frame(t: Derived) -> DataFrame:
    records = t.prompts().select("active", F.col("version").cast("string").alias("version"), "prompt_id", F.lit(1).alias("other"))
    return store_of.conformed(records, "prompts").select("prompt_id", "version", "content", "active")


@query
def extract_pipeline(t: Derived) -> DataFrame:
    store, folder = _store(t), _text_folder(t)
    run = F.regexp_extract("document_path", r"file_name=doc_([0-9]+)", 1).cast("long") * 10 + 1
    for _ in range(2):
        extract.run_extract(t.spark, store, folder, run, F.lit("batch"), AS_OF, suffix=".txt", prefix="file:")
    return store.read("extracted_documents").select("extraction_id", "extraction_run_id", "extracted_text", "page_count")


def _counting_model():
    def model(text: str) -> str:
        if "|" in text:
            raise ValueError("not prose")
        return f"{len(text)} characters"

    return model


@query
def summarize_pipeline(t: Derived) -> DataFrame:
    store = _store(t, job_events=t.job_events(), extracted_documents=t.extracted_documents())
    for _ in range(2):
        summarize.run_summarize(t.spark, store, F.col("extraction_run_id") + 1, F.lit("batch"), AS_OF, _counting_model, "counting")
    return store.read("summaries").select("summary_id", "summarization_run_id", "extraction_run_id", "summary_text")


@query
def upload_pipeline(t: Derived) -> DataFrame:
    store = _store(t, job_events=t.job_events(), summaries=t.summaries())
    for _ in range(2):
        upload.run_upload(t.spark, store, scratch(t.spark, "published"), SITE, AS_OF)
    written = store.read("job_events").filter(F.col("run_id") == V.NO_RUN)
    return written.withColumn("timestamp", F.col("timestamp").cast(NTZ))


# --- streams -------------------------------------------------------------------------------


def _stream(t: Derived) -> DataFrame:
    raw = streams.event_stream(t.spark, t.root, t.raw("events").schema, "events.parquet")
    return Derived.as_job_events(raw)


@query
def synced_status(t: Derived) -> DataFrame:
    target = scratch(t.spark, "synced")
    changes.sync(_stream(t), ["run_id"], "timestamp", target, f"{target}/checkpoint").awaitTermination()
    return changes.replica(t.spark, target, ["run_id"], "timestamp").select(
        "run_id", "agent", "sp_used", "status", F.col("timestamp").alias("updated_at")
    )


@query
def folded_status(t: Derived) -> DataFrame:
    target, key = scratch(t.spark, "folded"), ["run_id"]
    # The log in eight files, a batch each, dealt by event so that every batch brings late rows.
    t.job_events().repartition(8, "event_id").write.parquet(f"{target}/log")
    log = streams.event_stream(t.spark, f"{target}/log", t.job_events().schema, files_per_batch=1)
    folds.sync(log, key, "timestamp", target, f"{target}/checkpoint", every=3).awaitTermination()
    return folds.replica(t.spark, target, key, "timestamp").select(
        "run_id", "agent", "sp_used", "status", F.col("timestamp").alias("updated_at")
    )


@query
def dedup_events(t: Derived) -> DataFrame:
    target = scratch(t.spark, "dedup")
    twice = _stream(t).unionByName(_stream(t))
    streams.append_to(streams.dedup_events(twice, "31 days"), f"{target}/events", f"{target}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{target}/events").withColumn("timestamp", F.col("timestamp").cast(NTZ))


@query
def live_volume(t: Derived) -> DataFrame:
    target = scratch(t.spark, "volume")
    streams.publish_updates(streams.live_volume(_stream(t), "31 days"), target, f"{target}/checkpoint").awaitTermination()
    newest = changes.replica(t.spark, target, ["window_start", "agent"], "version", "version")
    return newest.select(
        F.col("window_start").cast(NTZ).alias("window_start"), "agent", "events", "failed", "error_rate"
    )


@query
def silent_runs(t: Derived) -> DataFrame:
    target = scratch(t.spark, "silent")
    silent = streams.stalled_sessions(_stream(t), V.EXTRACTION, "1 day")
    streams.append_to(silent, f"{target}/runs", f"{target}/checkpoint").awaitTermination()
    rows = t.spark.read.parquet(f"{target}/runs").unionByName(streams.stalled_since(t.job_events(), V.EXTRACTION, "1 day"))
    return rows.select("run_id", *[F.col(c).cast(NTZ).alias(c) for c in ("started_at", "gave_up_at")])


@query
def silent_runs_timed(t: Derived) -> DataFrame:
    target = scratch(t.spark, "timed")
    streams.append_to(timers.silent_runs(_stream(t), V.EXTRACTION), f"{target}/runs", f"{target}/checkpoint").awaitTermination()
    rows = t.spark.read.parquet(f"{target}/runs").unionByName(timers.held_silent_runs(t.spark, f"{target}/checkpoint", V.EXTRACTION))
    return rows.select("run_id", *[F.col(c).cast(NTZ).alias(c) for c in ("started_at", "gave_up_at")])


@query
def live_bursts(t: Derived) -> DataFrame:
    target, limit, seconds = scratch(t.spark, "bursts"), 2, 6 * 3600
    found = timers.bursts(_stream(t), "triggered_by", "timestamp", "event_id", limit, seconds)
    streams.append_to(found, f"{target}/bursts", f"{target}/checkpoint").awaitTermination()
    rows = t.spark.read.parquet(f"{target}/bursts").unionByName(timers.held_bursts(t.spark, f"{target}/checkpoint", limit, seconds))
    return rows.select(F.col("key").alias("triggered_by"), "event_id", F.col("at").cast(NTZ).alias("ts"), F.col("since").cast(NTZ).alias("since"))


@query
def paths_of_collection(t: Derived) -> DataFrame:
    return X.paths_like(t.extracted_documents(), "document_path", "%/source_pdfs/%", contains="patient_1").select(
        "extraction_id", "document_path"
    )


@query
def stage_trigger(t: Derived) -> DataFrame:
    target = scratch(t.spark, "actions")
    streams.append_to(streams.stage_trigger(Derived.linked(_stream(t)), "31 days"), f"{target}/actions", f"{target}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{target}/actions")
