"""Messages of one user in one batch: each sees what the earlier ones did."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from oracle_compare import compare
from pyspark.sql import functions as F

from vellumflow import vocabulary as V
from vellumflow.plans import ordered
from vellumflow.registry import queries as registry
from vellumflow.registry.oracle import ORACLE

MESSAGES = "event_id long, user_id string, ts timestamp, content string"
NOW = datetime(2024, 1, 31)
EXTRACT, ASK = "Extract /source_pdfs/a.pdf", "What's the status?"


def routed(spark, messages, st, ev):
    frame = spark.createDataFrame([(i, u, NOW - timedelta(minutes=60 - t), c) for i, (u, t, c) in enumerate(messages)], MESSAGES)
    out = ordered.route_in_order(
        frame, st, ev, "https://example.test/site", new_run=F.col("event_id") * 10 + 1, next_run=F.col("extraction_run_id") + 1, as_of=NOW, hours=2
    )
    return {r["event_id"]: r for r in out.collect()}


@pytest.fixture
def empty_log(make_log):
    return make_log()


def test_a_started_workflow_is_seen(spark, make_state, make_log):
    got = routed(spark, [("u", 1, EXTRACT), ("u", 2, ASK), ("u", 3, "Extract /source_pdfs/b.pdf"), ("v", 2, ASK)], make_state(), make_log())
    assert [(got[k]["route"], got[k]["action"]) for k in range(4)] == [("extract_document", None), ("workflow", "wait"), ("workflow", "wait"), ("check_status", None)]
    assert "**Run ID:** 1 " in got[0]["reply"] and "Extraction in progress... (0 min elapsed, ETA: 30 min)" in got[2]["reply"]


def test_a_workflow_runs_through_and_is_cleared(spark, make_state, make_log):
    """Extraction done, summary done, upload, cleared; then a new request starts."""
    st = make_state(("w", "u", 501, None, V.EXTRACTING, "2024-01-30 23:30:00", V.IN_PROGRESS))
    ev = make_log(
        ("a", "ExtractionJobCompleted", 501, "extraction_agent", "u", "2024-01-30 23:40:00"),
        ("b", "SummarizationJobCompleted", 502, "summarization_agent", "u", "2024-01-30 23:45:00"),
    )
    got = routed(spark, [("u", k, EXTRACT if k > 2 else "") if k == 1 else ("u", k, EXTRACT) for k in range(7)], st, ev)
    kinds = [(got[k]["route"], got[k]["action"]) for k in range(7)]
    assert kinds[0] == ("workflow", "start_summarization") and kinds[1][0] == "empty"
    assert kinds[2:5] == [("workflow", "upload"), ("workflow", "clear"), ("extract_document", None)]
    assert kinds[5:] == [("workflow", "wait")] * 2
    assert "summary_502.pdf" in got[2]["reply"] and got[3]["reply"] == V.MSG_PREVIOUS_DONE


def test_a_failed_run_frees_the_user(spark, make_state, make_log):
    st = make_state(("w", "u", 501, None, V.EXTRACTING, "2024-01-30 23:30:00", V.IN_PROGRESS))
    ev = make_log(("a", "ExtractionJobFailed", 501, "extraction_agent", "u", "2024-01-30 23:40:00"))
    got = routed(spark, [("u", 1, ASK), ("u", 2, ASK)], st, ev)
    assert got[0]["action"] == "clear" and got[1]["reply"] == V.MSG_NO_WORKFLOW


def plain_routes(messages, steps_of_user, steps_of_run):
    """Route of each message by a loop; ``steps`` are those of a workflow until it is cleared, or None for ever."""
    left, out = dict(steps_of_user), {}
    for i, (user, _, content) in sorted(enumerate(messages), key=lambda m: (m[1][1], m[0])):
        busy = user is not None and user in left
        if not content:
            out[i] = "empty"
        elif busy:
            out[i] = "workflow"
            if left[user] is not None:
                left[user] -= 1
                if not left[user]:
                    del left[user]
        else:
            out[i] = "extract_document" if content == EXTRACT else "check_status"
            if content == EXTRACT and user is not None:
                left[user] = steps_of_run(i * 10 + 1)
    return out


@pytest.mark.parametrize("range_rows", [200_000, 23, 5])
def test_hot_user_over_many_ranges(spark, monkeypatch, make_state, make_log, range_rows):
    """A third of the messages on one user; every range brings its map, whatever it starts with."""
    monkeypatch.setattr(ordered, "RANGE_ROWS", range_rows)
    rng = random.Random(range_rows)
    users = ["hot", None, *[f"u{k}" for k in range(12)]]
    messages = [(users[0] if rng.random() < 0.34 else rng.choice(users[1:]), rng.randint(0, 40), rng.choice([EXTRACT, ASK, ASK, "", None])) for _ in range(400)]

    def steps_of_run(run):
        kind = run // 10 % 4
        return {0: 1, 1: 3, 2: 2, 3: None}[kind] if run // 10 < 380 else None

    log = []
    for i in range(380):
        run, kind = i * 10 + 1, i % 4
        if kind < 3:
            log.append((f"e{i}", "ExtractionJobFailed" if kind == 0 else "ExtractionJobCompleted", run, "extraction_agent", "x", "2024-01-30 20:00:00"))
        if kind in (1, 2):
            log.append((f"s{i}", "SummarizationJobCompleted" if kind == 1 else "SummarizationJobFailed", run + 1, "summarization_agent", "x", "2024-01-30 21:00:00"))
    log.append(("done", "SummarizationJobCompleted", 90002, "summarization_agent", "x", "2024-01-30 21:00:00"))
    st = make_state(
        ("w1", "hot", 90001, 90002, V.SUMMARIZING, "2024-01-30 23:30:00", V.IN_PROGRESS), ("w2", "u3", 90011, None, V.EXTRACTING, "2024-01-30 23:30:00", V.IN_PROGRESS),
        ("w3", "u4", 90021, 90022, V.DONE, "2024-01-30 23:30:00", V.IN_PROGRESS), ("w4", "u5", 90031, None, V.EXTRACTING, "2024-01-30 21:30:00", V.IN_PROGRESS),
    )
    got = routed(spark, messages, st, make_log(*log))
    expected = plain_routes(messages, {"hot": 2, "u3": None, "u4": 1}, steps_of_run)
    assert {i: r["route"] for i, r in got.items()} == expected
    assert len(Counter(expected.values())) == 4


def test_no_messages(spark, make_state, empty_log):
    assert routed(spark, [], make_state(), empty_log) == {}


@pytest.mark.parametrize("name", ["route_in_order"])
def test_many_ranges_give_the_sql_result(spark, sf, con, monkeypatch, name):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 40)
    count, difference = compare(registry.QUERIES[name](spark, sf), con, ORACLE[name])
    assert difference is None and count > 0
