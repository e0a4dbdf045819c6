"""A third of all rows on one user, run and document group; no broadcast joins."""

from __future__ import annotations

import re
import shutil

import duckdb
import pytest
from conftest import SF
from oracle_compare import TABLES, compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from vellumflow.operators import lineage, workflow
from vellumflow.plans import routing

QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()
KEYED = [
    "job_status_latest", "latest_event_per_run_agent", "run_status", "ready_for_summarization", "blocked_runs",
    "events_for_run", "pending_workflow", "workflow_advance", "workflow_state_from_events", "update_workflow_stage",
    "clear_workflow_state", "job_status_lookup", "unified_status", "tier_drift", "latest_summary", "extraction_for_run",
    "document_lineage", "summary_metadata", "upload_manifest", "stage_durations", "event_gaps", "stalled_runs",
    "latency_percentiles", "documents_processed", "key_violations", "rate_limit_violations", "active_prompt",
    "route_messages", "route_in_order", "summarize_batch", "knowledge_topk", "synced_status", "stage_trigger",
]
SKEWED = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "2KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "2KB",
}


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    """The small tables again, with every third event on one user and time of
    day, and every third document in one run."""
    where = tmp_path_factory.mktemp("hot")
    for t in TABLES:
        shutil.copy(f"{SF}/{t}.parquet", where / f"{t}.parquet")
    (where / "events.parquet").unlink()
    (where / "documents.parquet").unlink()
    con = duckdb.connect()
    con.execute(
        f"COPY (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('day', ts) + event_id * INTERVAL 1 MILLISECOND ELSE ts END AS ts, "
        f"CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id, event_type, value, props "
        f"FROM '{SF}/events.parquet') TO '{where}/events.parquet' (FORMAT parquet)"
    )
    con.execute(
        f"COPY (SELECT CASE WHEN doc_id % 3 = 0 THEN doc_id * 150 ELSE doc_id END AS doc_id, text, lang, source, n_chars "
        f"FROM '{SF}/documents.parquet') TO '{where}/documents.parquet' (FORMAT parquet)"
    )
    return str(where)


@pytest.mark.parametrize("name", KEYED)
def test_hot_keys_change_nothing(spark, conf, hot, name):
    conf(**SKEWED)
    count, difference = compare(QUERIES[name](spark, hot), connect(hot), ORACLE[name])
    assert difference is None and count > 0


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def big_state(spark):
    """30,000 open workflows, a third of them of one user."""
    return spark.range(0, 30_000, 1, 8).select(
        F.col("id").cast("string").alias("state_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
        F.lit("/p").alias("document_path"),
        F.col("id").alias("extraction_run_id"),
        F.lit(None).cast("long").alias("summarization_run_id"),
        F.lit("extracting").alias("current_stage"),
        F.current_timestamp().alias("triggered_at"),
        F.lit("in_progress").alias("status"),
    )


def test_hot_user_is_split_in_state_updates(spark, conf, big_state):
    conf(**SKEWED)
    users = big_state.select("user_id").distinct()
    change = users.select("user_id", F.lit("summarizing").alias("stage"), F.lit(7).cast("long").alias("summarization_run_id"))
    updated = workflow.update_stage(big_state, change)
    assert "skew=true" in final_plan(updated)
    assert updated.filter("current_stage = 'summarizing'").count() == 30_000
    assert "skew=true" in final_plan(workflow.clear_state(big_state, users))


def test_hot_user_is_split_in_routing(spark, conf, big_state, make_log):
    conf(**SKEWED)
    log = make_log(("1", "ExtractionJobFailed", 3, "extraction_agent", "u", "2024-01-01 00:00:00"))
    asked = big_state.select(F.col("state_id").cast("long").alias("event_id"), "user_id", F.lit("status?").alias("content"))
    replies = routing.route(asked, big_state, log, "https://s", F.lit(1), F.lit(2))
    assert "skew=true" in final_plan(replies.select("event_id", "reply"))
    assert replies.filter("route = 'workflow'").count() == 30_000


def test_hot_run_is_split_in_lineage(spark, conf, make_log):
    conf(**SKEWED)
    run = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("extraction_run_id")
    key = F.col("id").cast("string")
    ex = spark.range(0, 30_000, 1, 8).select(
        key.alias("extraction_id"), run, F.sha2(key, 256).alias("document_path"), key.alias("extracted_text"),
        F.lit(1).alias("page_count"), F.current_timestamp().alias("extracted_at"),
    )
    su = spark.range(0, 30_000, 1, 8).select(
        F.sha2(key, 256).alias("summary_id"), (F.col("id") + 100_000).alias("summarization_run_id"), run,
        key.alias("summary_text"), F.current_timestamp().alias("summarized_at"),
    )
    log = make_log(("1", "ExtractionJobFailed", 3, "extraction_agent", "u", "2024-01-01 00:00:00"))
    rows = lineage.document_lineage(ex, su, log)
    assert "skew=true" in final_plan(rows) and rows.count() == 30_000
    lengths = lineage.summary_metadata(ex, su)
    assert "skew=true" in final_plan(lengths) and lengths.count() == 30_000


def test_rows_without_a_key_are_spread(spark, conf, big_state, make_log):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    log = make_log(("1", "ExtractionJobFailed", 3, "extraction_agent", "u", "2024-01-01 00:00:00"))
    idle = big_state.withColumn("current_stage", F.when(F.col("state_id") != "1", "uploading").otherwise("extracting"))
    joined = workflow.with_run_status(idle, log)
    assert re.search(r"SortMergeJoin|ShuffledHashJoin", joined._jdf.queryExecution().executedPlan().toString())
    sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 2 * 30_000 / len(sizes)
