"""The documented example: one document from request to upload."""

from __future__ import annotations

import pytest
from conftest import at, rows

from vellumflow.operators import latest, lineage, sequences, status, workflow
from vellumflow.plans import projection

E, S, U = "extraction_agent", "summarization_agent", "sharepoint_agent"
LOG = [
    ("1", "ExtractionJobStarted", 12345, E, "user123", "2025-11-02 10:00:00", '{"document_path":"/source_pdfs/patient_1.pdf"}'),
    ("2", "ExtractionJobCompleted", 12345, E, "user123", "2025-11-02 10:30:00"),
    ("3", "SummarizationJobStarted", 67890, S, "user123", "2025-11-02 10:30:05", '{"extraction_run_id":12345}'),
    ("4", "SummarizationJobCompleted", 67890, S, "user123", "2025-11-02 10:40:00", '{"extraction_run_id":12345}'),
    ("5", "SharePointUploadCompleted", 0, U, "user123", "2025-11-02 10:40:05", '{"summarization_run_id":67890}'),
]
STATE = ["extraction_run_id", "summarization_run_id", "current_stage", "status"]


@pytest.mark.parametrize(
    ("events", "expected"),
    [
        (1, (12345, None, "extracting", "in_progress")),
        (3, (12345, 67890, "summarizing", "in_progress")),
        (4, (12345, 67890, "uploading", "in_progress")),
        (5, (12345, 67890, "completed", "completed")),
    ],
)
def test_state_over_time(make_log, events, expected):
    state = projection.workflow_state_from_events(make_log(*LOG[:events]))
    assert rows(state, *STATE) == [expected]
    assert rows(state, "user_id", "document_path") == [("user123", "/source_pdfs/patient_1.pdf")]


def test_latest_status(make_log):
    got = rows(latest.job_status_latest(make_log(*LOG)), "run_id", "latest_status")
    assert got == [(0, "SharePointUploadCompleted"), (12345, "ExtractionJobCompleted"), (67890, "SummarizationJobCompleted")]


def test_audit_trail_order(make_log):
    log = make_log(*reversed(LOG))
    trail = status.audit_trail(log, log.selectExpr("triggered_by AS user_id").distinct())
    assert [r.event_id for r in trail.collect()] == ["1", "2", "3", "4", "5"]


def test_durations(make_log):
    got = rows(sequences.stage_durations(make_log(*LOG)), "run_id", "duration_seconds")
    assert got == [(12345, 1800.0), (67890, 595.0)]


def test_gaps(make_log):
    got = sequences.event_gaps(make_log(*LOG)).orderBy("timestamp").collect()
    assert [r.gap_seconds for r in got] == [None, 1800.0, 5.0, 595.0, 5.0]


def test_upload_found_through_details(make_log):
    got = rows(lineage.upload_outcomes(make_log(*LOG)), "summarization_run_id", "event_type")
    assert got == [(67890, "SharePointUploadCompleted")]


def test_steps(make_log, make_state):
    log = make_log(*LOG)
    state = make_state(
        ("a", "user123", 12345, None, "extracting", "2025-11-02 10:00:00", "in_progress"),
        ("b", "user123", 12345, 67890, "summarizing", "2025-11-02 10:30:00", "in_progress"),
    )
    got = rows(workflow.advance(state, log, at("2025-11-02 11:00:00")), "state_id", "run_status", "action", "next_stage", "next_status")
    assert got == [
        ("a", "COMPLETED", "start_summarization", "summarizing", "in_progress"),
        ("b", "COMPLETED", "upload", "completed", "in_progress"),
    ]
