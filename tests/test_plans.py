"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from conftest import at
from pyspark.sql import functions as F

from vellumflow import vocabulary as V
from vellumflow.operators import latest, status
from vellumflow.registry import queries as registry
from vellumflow.sources import store as store_module
from vellumflow.sources.store import TableStore

QUERIES = registry.QUERIES
PYTHON_ALLOWED = {"knowledge_topk", "knowledge_reply", "product_topk", "catalog_replies"}
# Building these writes files or runs a stream first.
EAGER = {"replayed_changes", "route_in_order", "indexed_topk", "indexed_topk_exact", "run_status_by_run", "summary_by_run", "read_documents", "list_summaries", "get_summary", "synced_status", "dedup_events", "live_volume", "stage_trigger", "silent_runs",
         "table_roundtrip", "named_table", "rows_to_frame", "extract_pipeline", "summarize_pipeline", "upload_pipeline"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pushed(df):
    return re.findall(r"PushedFilters: \[(.*)\]", df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON_ALLOWED:
        assert not re.search(r"Python|InPandas|ArrowEval", text)


@pytest.mark.parametrize(
    "name", ["job_status_latest", "latest_event_per_run_agent", "run_status", "latest_summary", "pending_workflow", "synced_status"]
)
def test_newest_row_is_reduced_before_the_shuffle(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "partial_max(struct(" in text or "partial_max_by" in text


@pytest.mark.parametrize("name", ["document_lineage", "key_violations", "blocked_runs", "ready_for_summarization"])
def test_texts_are_not_read_for_keys(spark, sf, name):
    for schema in re.findall(r"documents\.parquet\].*?ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, sf))):
        assert "text" not in schema


@pytest.mark.parametrize("name", ["audit_tail", "recent_events", "recent_checkpoints", "top_queries"])
def test_limits_are_top_k(spark, sf, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf))


def test_filters_reach_the_scan(spark, tmp_path, make_log, make_state):
    store = TableStore(spark, str(tmp_path))
    store.append("job_events", make_log(("1", "JobStarted", 1, "extraction_agent", "u", "2024-01-01 00:00:00")))
    store.append("conversation_state", make_state(("a", "u", 1, None, "extracting", "2024-01-01 00:00:00", "in_progress")))
    (run,) = pushed(status.ready_runs(spark.createDataFrame([(1,)], "run_id long"), store.read("job_events")))
    assert "EqualTo(agent,extraction_agent)" in run and "Not(EqualTo(run_id,0))" in run
    (open_rows,) = pushed(latest.pending_workflow(store.read("conversation_state"), at("2024-01-02 00:00:00")))
    assert "EqualTo(status,in_progress)" in open_rows and "GreaterThan(triggered_at" in open_rows


def test_percentiles_read_the_log_once(spark, sf):
    df = QUERIES["latency_percentiles"](spark, sf)
    df.collect()
    assert plan(df).split("Initial Plan")[0].count("FileScan") == 1


def scanned_rows(df):
    """Rows that the scans of an executed plan gave."""
    df.collect()
    nodes, total = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            nodes.append(node.plan())
            continue
        if name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_few_runs_open_few_folders(spark, conf, tmp_path, make_log):
    """Ten runs of 5,000: ten folders at most, and no more rows than those folders hold."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    agents = [V.EXTRACTION, V.SUMMARIZATION]
    store = TableStore(spark, str(tmp_path), by_run=True)
    base = make_log(("1", "ExtractionJobStarted", 1, "extraction_agent", "u", "2024-01-01 00:00:00"))
    kinds = F.array(*[F.lit(a.started) for a in agents])
    names = F.array(*[F.lit(a.name) for a in agents])
    k = F.col("id")
    log = base.drop("event_id", "run_id", "event_type", "agent").crossJoin(spark.range(20_000)).select(
        k.cast("string").alias("event_id"), F.get(kinds, (k % 2).cast("int")).alias("event_type"), (1 + k % 5000).alias("run_id"),
        F.get(names, (k % 2).cast("int")).alias("agent"), "sp_used", "triggered_by", (F.col("timestamp") + F.make_dt_interval(mins=k.cast("int"))).alias("timestamp"), "status", "details",
    )
    store.append("job_events", log)
    requested = spark.createDataFrame([(r,) for r in range(11, 30, 2)], "run_id long")
    found = store.read_runs("job_events", requested)
    (folders,) = re.findall(r"PartitionFilters: \[[^]]*run_bucket#\d+ IN \(([\d,]+)\)", plan(found))
    assert len(folders.split(",")) <= 10 and "In(run_id, [" in pushed(found)[0]
    assert found.count() == 40
    # The status of the ten runs reads a few hundred rows, not 20,000, and shuffles those of the ten runs only.
    report = status.run_status(requested, found, as_of=at("2024-02-01 00:00:00"))
    assert {r["run_id"]: r["status"] for r in report.collect()} == {r: "RUNNING" for r in range(11, 30, 2)}
    assert scanned_rows(report) < 2_000
    whole = status.run_status(requested, store.read("job_events"), as_of=at("2024-02-01 00:00:00"))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, whole.collect()))


def test_many_runs_are_joined(spark, conf, tmp_path, make_log, monkeypatch):
    monkeypatch.setattr(store_module, "MAX_LISTED_RUNS", 1)
    store = TableStore(spark, str(tmp_path), by_run=True)
    log = make_log(*[(str(k), "ExtractionJobStarted", k % 3, "extraction_agent", "u", "2024-01-01 00:00:00") for k in range(9)])
    store.append_new("job_events", log)
    store.append("job_events", log)  # as after a job that broke off between the two layouts
    requested = spark.createDataFrame([(1,), (2,), (2,), (7,), (None,)], "run_id long")
    assert sorted(r["event_id"] for r in store.read_runs("job_events", requested).collect()) == ["1", "2", "4", "5", "7", "8"]
    assert store.read_runs("job_events", requested.limit(0)).count() == 0
