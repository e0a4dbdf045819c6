"""Shared session and inputs."""

from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from oracle_compare import connect  # noqa: E402
from vellumflow.schemas import CONVERSATION_STATE, JOB_EVENTS  # noqa: E402
from vellumflow.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("vellumflow-tests", cores=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def con():
    return connect(SF)


@pytest.fixture
def conf(spark):
    """Set runtime settings for one test."""
    saved = {}

    def put(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield put
    for key, value in saved.items():
        spark.conf.set(key, value)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def make_log(spark):
    """Event log from (event_id, event_type, run_id, agent, user, time[, details])."""
    principal = {
        "extraction_agent": "EXTRACTION_SP",
        "summarization_agent": "SUMMARIZATION_SP",
        "sharepoint_agent": "SHAREPOINT_SP",
    }

    def build(*rows):
        full = []
        for event_id, kind, run, agent, user, when, *rest in rows:
            status = "SUCCESS" if kind.endswith("Completed") else "FAILED" if kind.endswith("Failed") else "RUNNING"
            full.append((event_id, kind, run, agent, principal[agent], user, at(when), status, rest[0] if rest else None))
        return spark.createDataFrame(full, JOB_EVENTS)

    return build


@pytest.fixture(scope="session")
def make_state(spark):
    """State rows from (state_id, user, extraction run, summarization run, stage, time, status)."""

    def build(*rows):
        full = [(s, u, f"/source_pdfs/{s}.pdf", e, m, stage, at(t), status) for s, u, e, m, stage, t, status in rows]
        return spark.createDataFrame(full, CONVERSATION_STATE)

    return build


def rows(df, *columns):
    """Rows of the given columns as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
