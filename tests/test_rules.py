"""Hand cases for the rules that data alone would not show."""

from __future__ import annotations

from datetime import timedelta, timezone

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from vellumflow import vocabulary as V
from vellumflow.functions import details, text, times
from vellumflow.operators import events, governance, latest, metrics, sequences, status, tiers, workflow
from vellumflow.plans import projection, routing, upload
from vellumflow.schemas import CHAT_MESSAGES, JOB_STATUS, SCHEMAS, SUMMARIES, conform

E, S, U = "extraction_agent", "summarization_agent", "sharepoint_agent"
NOW = at("2024-01-02 12:00:00")


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


# --- text -------------------------------------------------------------------


@pytest.mark.parametrize(
    ("message", "intent"),
    [
        ("Extract /source_pdfs/patient_123.pdf", "extract_document"),
        ("What's the status?", "check_status"),
        ("Tell me about treatment protocols", "search_knowledge"),
        ("What gaming laptops do you have?", "general"),
        ("find the STATUS of my search", "check_status"),
        ("check the extract", "extract_document"),
        ("my findings", "search_knowledge"),
        ("/source_pdfs/x", "extract_document"),
        ("", "general"),
    ],
)
def test_intent_order_and_substrings(spark, message, intent):
    assert one(spark, message, text.classify_intent) == intent


@pytest.mark.parametrize(("message", "target"), [("Please refresh the data", "refresh"), ("a cold day", "refresh"), ("laptops", "search")])
def test_refresh(spark, message, target):
    assert one(spark, message, text.classify_refresh) == target


@pytest.mark.parametrize(
    ("message", "path"),
    [
        ("Extract /source_pdfs/patient_123.pdf", "/source_pdfs/patient_123.pdf"),
        ("x/source_pdfs/a.pdf /source_pdfs/b.pdf", "/source_pdfs/a.pdf"),
        ("Extract /source_pdfs/patient_123.txt", None),
        ("see /source_pdfs/o'neil.pdf", "/source_pdfs/o'neil.pdf"),
        ("nothing", None),
    ],
)
def test_document_path(spark, message, path):
    assert one(spark, message, text.document_path) == path


def test_volume_path(spark):
    assert one(spark, "Extract /Volumes/c/s/p/patient_001.txt now", text.volume_path) == "/Volumes/c/s/p/patient_001.txt"
    assert one(spark, "read /Volumes/c/s/p/patient_001.txt", text.volume_path) is None
    assert one(spark, "extract it", text.volume_path) is None
    assert one(spark, "extract it", text.volume_reply) == V.MSG_NO_VOLUME_PATH


@pytest.mark.parametrize(("raw", "run"), [("RunId(12345)", 12345), ("67890", 67890), ("none", None), ("9" * 30, None)])
def test_parse_run_id(spark, raw, run):
    assert one(spark, raw, text.parse_run_id) == run


@pytest.mark.parametrize(("body", "pages"), [("", 1), ("a", 1), ("a\n\nb", 2), ("a\n\n\nb", 2), ("a\n\n\n\nb", 3)])
def test_pages_match_plain_count(spark, body, pages):
    assert one(spark, body, text.page_count) == pages == body.count("\n\n") + 1


def test_line_ends(spark):
    assert one(spark, "a\r\n\r\nb\rc", text.unix_lines) == "a\n\nb\nc"


def test_leading_sentences(spark):
    assert one(spark, "One. Two! Three? Four.", text.leading_sentences) == "One. Two! Three?"
    assert one(spark, "no end", text.leading_sentences) == "no end"


def test_last_of_chat_array(spark):
    df = spark.createDataFrame([([("user", "a"), ("user", "b")],), ([],), (None,)], f"m {CHAT_MESSAGES.simpleString()}")
    assert [r[0] for r in df.select(text.last_of(F.col("m"))).collect()] == ["b", V.MSG_EMPTY, V.MSG_EMPTY]


def test_stable_id_repeats(spark):
    df = spark.range(2).select(text.stable_id(F.col("id"), F.lit("x")).alias("a"), text.stable_id(F.col("id"), F.lit("x")).alias("b"))
    first, second = df.collect()
    assert first.a == first.b != second.a and len(first.a) == 36


def test_ratio(spark):
    df = spark.createDataFrame([(13, 40), (5, 0), (137, 137)], "a int, b int")
    got = [r[0] for r in df.select(details.ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.33, None, 1.0]


# --- time ---------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_minutes_count_whole_days(spark, kind):
    df = spark.createDataFrame([("2024-01-01 11:59:00.5",), ("2024-01-02 11:58:00.000001",)], "t string").select(F.col("t").cast(kind).alias("t"))
    now = times.instant(NOW)
    got = [tuple(r) for r in df.select(times.whole_minutes(now, F.col("t")), times.view_minutes(now, F.col("t"))).collect()]
    assert got == [(24 * 60, 24 * 60 + 1), (1, 2)]


def test_iso_format(spark):
    assert one(spark, at("2024-01-02 03:04:05"), times.iso_format, "timestamp") == "2024-01-02T03:04:05"
    assert one(spark, at("2024-01-02 03:04:05.000600"), times.iso_format, "timestamp") == "2024-01-02T03:04:05.000600"


def test_current_time_is_the_default(spark, make_state):
    state = make_state(("a", "u", 1, None, "extracting", "2000-01-01 00:00:00", "in_progress"))
    fresh = state.withColumn("triggered_at", F.current_timestamp() - F.lit(timedelta(minutes=5)))
    assert status.active_workflows(state).count() == 0
    assert [r.elapsed_minutes for r in status.active_workflows(fresh).collect()] == [5]


# --- status ---------------------------------------------------------------------


def test_event_type_decides_and_ties_prefer_greater_id(spark, make_log):
    log = make_log(
        ("1", "ExtractionJobStarted", 1, E, "u", "2024-01-02 11:00:00"),
        ("3", "ExtractionJobFailed", 1, E, "u", "2024-01-02 11:30:00"),
        ("2", "ExtractionJobCompleted", 1, E, "u", "2024-01-02 11:30:00"),
        ("4", "ExtractionJobStarted", 2, E, "u", "2024-01-01 11:00:00"),
        ("5", "SummarizationJobCompleted", 3, S, "u", "2024-01-02 11:00:00"),
        ("6", "JobStarted", 5, E, "u", "2024-01-02 11:55:30"),
    ).withColumn("status", F.lit("RUNNING"))
    requested = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "run_id long")
    got = {r.run_id: r for r in status.run_status(requested, log, V.EXTRACTION, as_of=NOW).collect()}
    assert {k: r.status for k, r in got.items()} == {1: "FAILED", 2: "RUNNING", 3: "NOT_FOUND", 4: "NOT_FOUND", 5: "RUNNING"}
    assert (got[2].elapsed_min, got[2].eta_min) == (25 * 60, 1)
    assert got[5].message == "Extraction in progress... (4 min elapsed, ETA: 26 min)"
    assert got[4].message == "No extraction job found with Run ID 4"
    assert (got[1].ready, got[2].ready, got[4].ready) == (None, False, None)


def test_gate_and_blocked_are_complements(spark, make_log):
    log = make_log(
        ("1", "ExtractionJobCompleted", 1, E, "u", "2024-01-01 00:00:00"),
        ("2", "ExtractionJobCompleted", 2, E, "u", "2024-01-01 00:00:00"),
        ("3", "ExtractionJobFailed", 2, E, "u", "2024-01-01 00:01:00"),
        ("4", "ExtractionJobCompleted", 0, E, "u", "2024-01-01 00:00:00"),
    )
    runs = spark.createDataFrame([(0,), (1,), (2,), (9,)], "run_id long")
    assert rows(status.ready_runs(runs, log), "run_id") == [(1,)]
    assert rows(status.blocked_runs(runs, log), "run_id", "status") == [(0, "NOT_FOUND"), (2, "FAILED"), (9, "NOT_FOUND")]
    reason = status.blocked_runs(runs, log).filter("run_id = 9").first().reason
    assert reason == "Extraction run 9 not completed or failed"


@pytest.mark.parametrize(
    ("stage", "event", "expected"),
    [
        ("extracting", "ExtractionJobCompleted", ("COMPLETED", "start_summarization", "summarizing", "in_progress")),
        ("extracting", "ExtractionJobFailed", ("FAILED", "clear", "extracting", "completed")),
        ("extracting", "ExtractionJobStarted", ("RUNNING", "wait", "extracting", "in_progress")),
        ("extracting", None, ("NOT_FOUND", "wait", "extracting", "in_progress")),
        ("summarizing", "SummarizationJobCompleted", ("COMPLETED", "upload", "completed", "in_progress")),
        ("summarizing", "SummarizationJobFailed", ("FAILED", "clear", "summarizing", "completed")),
        ("summarizing", "SummarizationJobStarted", ("RUNNING", "wait", "summarizing", "in_progress")),
        ("completed", None, (None, "clear", "completed", "completed")),
        ("uploading", None, (None, "unknown_state", "uploading", "in_progress")),
    ],
)
def test_decision_table(make_log, make_state, stage, event, expected):
    agent, run = (E, 1) if stage == "extracting" else (S, 2)
    log = make_log(("x", event or "ExtractionJobCompleted", run if event else 99, agent, "u", "2024-01-02 11:00:00"))
    state = make_state(("a", "u", 1, 2, stage, "2024-01-02 11:00:00", "in_progress"))
    got = rows(workflow.advance(state, log, NOW), "run_status", "action", "next_stage", "next_status")
    assert got == [expected]


def test_workflow_without_its_run_waits(make_log, make_state):
    log = make_log(("x", "SummarizationJobCompleted", 5, S, "u", "2024-01-02 11:00:00"))
    state = make_state(("a", "u", 1, None, "summarizing", "2024-01-02 11:00:00", "in_progress"))
    assert rows(workflow.advance(state, log, NOW), "run_status", "action") == [("NOT_FOUND", "wait")]


def test_old_and_closed_workflows_are_not_pending(make_state):
    state = make_state(
        ("a", "u", 1, None, "extracting", "2024-01-02 09:59:59", "in_progress"),
        ("b", "u", 2, None, "extracting", "2024-01-02 10:30:00", "in_progress"),
        ("c", "u", 3, None, "extracting", "2024-01-02 11:30:00", "completed"),
        ("d", "v", 4, None, "extracting", "2024-01-02 10:00:00", "in_progress"),
        ("e", "w", 5, None, "extracting", "2024-01-02 11:00:00", "in_progress"),
        ("f", "w", 6, None, "extracting", "2024-01-02 11:00:00", "in_progress"),
    )
    assert rows(latest.pending_workflow(state, NOW), "user_id", "state_id") == [("u", "b"), ("w", "f")]


# --- state changes -----------------------------------------------------------------


def test_update_touches_all_open_rows_of_the_user(spark, make_state):
    state = make_state(
        ("a", "u", 1, None, "extracting", "2024-01-01 00:00:00", "in_progress"),
        ("b", "u", 2, 7, "summarizing", "2024-01-02 00:00:00", "in_progress"),
        ("c", "u", 3, None, "extracting", "2024-01-02 00:00:00", "completed"),
        ("d", "v", 4, None, "extracting", "2024-01-02 00:00:00", "in_progress"),
    )
    with_run = spark.createDataFrame([("u", "summarizing", 99)], "user_id string, stage string, summarization_run_id long")
    without = spark.createDataFrame([("u", "completed", None)], "user_id string, stage string, summarization_run_id long")
    cols = ["state_id", "summarization_run_id", "current_stage", "status"]
    assert rows(workflow.update_stage(state, with_run), *cols) == [
        ("a", 99, "summarizing", "in_progress"), ("b", 99, "summarizing", "in_progress"),
        ("c", None, "extracting", "completed"), ("d", None, "extracting", "in_progress"),
    ]
    assert rows(workflow.update_stage(state, without), *cols)[1] == ("b", 7, "completed", "in_progress")
    users = spark.createDataFrame([("u",), ("u",)], "user_id string")
    assert rows(workflow.clear_state(state, users), "state_id", "status") == [
        ("a", "completed"), ("b", "completed"), ("c", "completed"), ("d", "in_progress")
    ]


def test_new_workflow_has_no_summarization_run(spark):
    asked = spark.createDataFrame([("u", "/source_pdfs/o'neil.pdf", 5)], "user_id string, document_path string, extraction_run_id long")
    got = events.new_workflows(asked, NOW)
    assert got.columns == workflow.STATE_COLUMNS
    assert rows(got, "document_path", "summarization_run_id", "current_stage", "status") == [
        ("/source_pdfs/o'neil.pdf", None, "extracting", "in_progress")
    ]


def test_event_details_leave_out_nulls(spark):
    runs = spark.createDataFrame([(1, "u", '/a"b\'.pdf', None), (2, "u", "/b", "boom")], "run_id long, triggered_by string, document_path string, error string")
    got = events.make_events(runs, V.EXTRACTION.failed, V.EXTRACTION, "RUNNING", NOW, ["document_path", "error"])
    assert got.columns == SCHEMAS["job_events"].fieldNames()
    parsed = got.orderBy("run_id").select(
        details.field(F.col("details"), "document_path"), details.field(F.col("details"), "error"), F.col("details").contains("error")
    )
    assert [tuple(r) for r in parsed.collect()] == [('/a"b\'.pdf', None, False), ("/b", "boom", True)]


def test_failed_projection(make_log):
    log = make_log(
        ("1", "ExtractionJobFailed", 1, E, "u", "2024-01-01 00:00:00"),
        ("2", "ExtractionJobCompleted", 2, E, "u", "2024-01-01 00:00:00"),
        ("3", "SummarizationJobFailed", 22, S, "u", "2024-01-01 00:10:00", '{"extraction_run_id":2}'),
        ("4", "ExtractionJobCompleted", 3, E, "u", "2024-01-01 00:00:00"),
        ("5", "SummarizationJobCompleted", 33, S, "u", "2024-01-01 00:10:00", '{"extraction_run_id":3}'),
        ("6", "SharePointUploadFailed", 0, U, "u", "2024-01-01 00:20:00", '{"summarization_run_id":33}'),
        ("7", "ExtractionJobFailed", 0, E, "u", "2024-01-01 00:00:00"),
    )
    got = rows(projection.workflow_state_from_events(log), "extraction_run_id", "current_stage", "status")
    assert got == [(1, "extracting", "failed"), (2, "summarizing", "failed"), (3, "uploading", "failed")]


# --- tiers --------------------------------------------------------------------------


def hot(spark, *rows_):
    full = [(r, "u", None, None, E, s, "EXTRACTION_SP", None, at(t) if t else None) for r, s, t in rows_]
    return spark.createDataFrame(full, JOB_STATUS)


def test_archive_parts_are_everything_once(spark):
    store = hot(
        spark,
        ("1", "SUCCESS", "2023-11-01 00:00:00"), ("2", "FAILED", "2023-12-03 11:59:59"), ("3", "FAILED", "2023-12-03 12:00:00"),
        ("4", "RUNNING", "2020-01-01 00:00:00"), ("5", "SUCCESS", None), ("6", None, "2020-01-01 00:00:00"),
    )
    archived, kept = tiers.split_archive(store, NOW)
    assert rows(archived, "run_id") == [("1",), ("2",)]
    assert rows(kept, "run_id") == [("3",), ("4",), ("5",), ("6",)]


def test_hot_row_wins_even_with_null_status(spark, make_log):
    store = hot(spark, ("1", None, None), ("test-7", "PENDING", "2024-01-01 00:00:00"))
    log = make_log(
        ("1", "ExtractionJobCompleted", 1, E, "u", "2024-01-01 00:00:00"),
        ("2", "ExtractionJobFailed", 2, E, "u", "2024-01-01 00:00:00"),
    )
    asked = spark.createDataFrame([("1",), ("2",), ("3",), ("test-7",), ("2",)], "run_id string")
    assert rows(tiers.lookup_status(asked, store, log), "run_id", "source", "status") == [
        ("1", "hot", None), ("2", "cold", "FAILED"), ("3", None, None), ("test-7", "hot", "PENDING")
    ]
    assert rows(tiers.unified_status(store, log), "run_id", "source") == [("1", "hot"), ("2", "cold"), ("test-7", "hot")]
    assert rows(tiers.tier_drift(store, log), "run_id", "drift") == [("1", "differs"), ("test-7", "missing")]


# --- sequences ---------------------------------------------------------------------------


def test_first_terminal_after_first_start(make_log):
    log = make_log(
        ("1", "ExtractionJobFailed", 1, E, "u", "2024-01-01 00:00:10"),
        ("2", "ExtractionJobStarted", 1, E, "u", "2024-01-01 00:00:20"),
        ("3", "ExtractionJobStarted", 1, E, "u", "2024-01-01 00:05:00"),
        ("4", "ExtractionJobCompleted", 1, E, "u", "2024-01-01 00:09:00"),
        ("5", "ExtractionJobFailed", 1, E, "u", "2024-01-01 00:09:30"),
        ("6", "ExtractionJobStarted", 2, E, "u", "2024-01-01 00:00:20"),
        ("7", "ExtractionJobCompleted", 2, E, "u", "2024-01-01 00:00:20"),
        ("8", "ExtractionJobCompleted", 3, E, "u", "2024-01-01 00:00:20"),
        ("9", "ExtractionJobStarted", 0, E, "u", "2024-01-01 00:00:20"),
    )
    got = rows(sequences.stage_durations(log), "run_id", "duration_seconds")
    assert got == [(1, 520.0), (2, 0.0)]


def test_stalled(make_log):
    log = make_log(
        ("1", "ExtractionJobStarted", 1, E, "u", "2024-01-02 10:59:59"),
        ("2", "ExtractionJobStarted", 2, E, "u", "2024-01-02 11:00:00"),
        ("3", "SummarizationJobStarted", 3, S, "u", "2024-01-02 10:00:00"),
        ("4", "SummarizationJobCompleted", 3, S, "u", "2024-01-02 10:30:01"),
        ("5", "SharePointUploadStarted", 4, U, "u", "2020-01-02 10:30:01"),
    )
    assert rows(sequences.stalled_runs(log, NOW), "run_id", "state") == [(1, "open"), (3, "late")]


# --- metrics and governance -------------------------------------------------------------


@pytest.mark.parametrize("values", [[7], [1, 2], [5, 5, 5, 2001, 2001, 9999], list(range(0, 5000, 7)), [3000, 1]])
def test_percentiles_are_exact(spark, values):
    usage = spark.createDataFrame([("a", v) for v in values] + [("b", 1), ("a", None)], "agent_id string, latency_ms int")
    got = metrics.latency_percentiles(usage).filter("agent_id = 'a'").first()
    want = usage.filter("agent_id = 'a'").select(*[F.round(F.percentile("latency_ms", F.lit(p)), 4) for p in (0.5, 0.95, 0.99)]).first()
    assert tuple(got)[1:] == tuple(want)


def test_all_missing_inputs_are_reported(spark):
    df = spark.createDataFrame([("", None), ("YOUR_NAME", "x"), ("a", "b")], "name string, job string")
    got = governance.validate_required(df, {"name": "no name", "job": "no job"}, ("YOUR_",))
    assert [r.errors for r in got.collect()] == [["no name", "no job"], ["no name"], []]


def test_first_broken_path_rule(spark):
    df = spark.createDataFrame([("/source_pdfs/a.pdf",), ("/other/a.pdf",), ("/other/a.txt",), (None,)], "document_path string")
    assert [r.reason for r in governance.validate_paths(df).collect()] == [None, V.BAD_PREFIX, V.BAD_SUFFIX, V.BAD_SUFFIX]
    good, bad = governance.split_paths(df)
    assert (good.count(), bad.count()) == (1, 3)


def test_instant_with_a_zone(spark):
    zoned = NOW.replace(tzinfo=timezone(timedelta(hours=2)))
    got = spark.range(1).select(
        times.instant(zoned, timedelta(hours=1)).cast("string"), times.instant(NOW, timedelta(hours=1)).cast("string")
    ).first()
    assert tuple(got) == ("2024-01-02 09:00:00", "2024-01-02 11:00:00")


def test_null_and_repeated_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert rows(governance.key_violations({"t": (df, "k")}), "key", "n") == [("a", 2), (None, 1)]


def test_redaction(spark):
    raw = "ssn 123-45-6789 card 4111 1111 1111 1111 mail a.b@c.example.org tel +1 (663) 555-6869."
    assert one(spark, raw, governance.redacted) == "ssn [SSN] card [CREDIT_CARD] mail [EMAIL] tel [PHONE]."


def test_wrong_principal(spark, make_log):
    log = make_log(("1", "JobStarted", 1, E, "u", "2024-01-01 00:00:00")).withColumn("sp_used", F.lit("client-id"))
    assert rows(governance.principal_isolation(log), "agent", "expected_sp", "isolated") == [(E, "EXTRACTION_SP", False)]


# --- chat and upload ------------------------------------------------------------------------


def test_pending_workflow_comes_before_intent(spark, make_log, make_state):
    log = make_log(("1", "ExtractionJobFailed", 1, E, "u", "2024-01-02 11:00:00"))
    state = make_state(("a", "u", 1, None, "extracting", "2024-01-02 11:00:00", "in_progress"))
    asked = spark.createDataFrame(
        [(1, "u", "Extract /source_pdfs/x.pdf"), (2, "v", "Extract /source_pdfs/x.pdf"), (3, "v", "status"), (4, "v", ""), (5, "v", "extract"), (6, "v", "what is x")],
        "event_id long, user_id string, content string",
    )
    found = spark.createDataFrame([(6, "answer")], "event_id long, reply string")
    got = {
        r.event_id: r
        for r in routing.route(asked, state, log, "https://s", F.lit(77), F.lit(78), NOW, knowledge=found).collect()
    }
    assert (got[1].route, got[1].reply) == ("workflow", "❌ Extraction failed: Extraction failed")
    assert got[2].route == "extract_document" and "**Run ID:** 77" in got[2].reply
    assert [got[i].reply for i in (3, 4, 5, 6)] == [V.MSG_NO_WORKFLOW, V.MSG_EMPTY, V.MSG_NO_PATH, "answer"]


def test_manifest_outcomes(spark, make_log):
    log = make_log(
        ("1", "SummarizationJobCompleted", 1, S, "u", "2024-01-01 00:00:00"),
        ("2", "SummarizationJobCompleted", 2, S, "u", "2024-01-01 00:00:00"),
        ("3", "SummarizationJobFailed", 3, S, "u", "2024-01-01 00:00:00"),
        ("4", "SummarizationJobCompleted", 4, S, "u", "2024-01-01 00:00:00"),
    )
    su = spark.createDataFrame(
        [("a", 1, 9, "text", None, NOW, "x"), ("b", 2, 9, "", None, NOW, "x"), ("c", 3, 9, "text", None, NOW, "x")], SUMMARIES
    )
    manifest = upload.upload_manifest(log, su, "https://s")
    assert rows(manifest, "summarization_run_id", "event_type", "reason") == [
        (1, "SharePointUploadCompleted", None),
        (2, "SharePointUploadFailed", "No summary found for run 2"),
        (3, None, "Summarization run 3 not completed or failed"),
        (4, "SharePointUploadFailed", "No summary found for run 4"),
    ]
    sent = upload.upload_events(manifest, NOW)
    assert rows(sent, "run_id", "status") == [(0, "COMPLETED"), (0, "FAILED"), (0, "FAILED")]
    assert sent.select("event_id").distinct().count() == 3


def test_conform_casts_and_fills(spark):
    df = spark.createDataFrame([(1, "x")], "page_count long, extraction_id string")
    got = conform(df, SCHEMAS["extracted_documents"])
    assert got.columns == SCHEMAS["extracted_documents"].fieldNames()
    assert dict(got.dtypes)["page_count"] == "int"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_sequences_ignore_the_session_zone(spark, conf, zone):
    """Wall-clock times around a clock change keep their order and distance."""
    conf(spark__sql__session__timeZone=zone)
    moments = ["2024-03-10 01:59:59", "2024-03-10 02:30:10", "2024-03-10 02:30:50", "2024-03-10 03:00:00", "2024-03-10 03:30:20"]
    kinds = ["Started", "Started", "Failed", "Completed", "Started"]
    log = spark.createDataFrame(
        [(str(i), f"ExtractionJob{k}", 1, E, "u", m) for i, (k, m) in enumerate(zip(kinds, moments))],
        "event_id string, event_type string, run_id long, agent string, triggered_by string, timestamp string",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    gaps = sequences.event_gaps(log).orderBy("event_id").collect()
    assert [r.gap_seconds for r in gaps] == [None, 1811.0, 40.0, 1750.0, 1820.0]
    assert [r.duration_seconds for r in sequences.stage_durations(log).collect()] == [1851.0]
