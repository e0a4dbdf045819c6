"""Sliding limits and the change feed, by hand and against plain versions."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from conftest import rows
from oracle_compare import compare
from pyspark.sql import functions as F

from vellumflow.operators import limits
from vellumflow.registry import queries as registry
from vellumflow.registry.oracle import ORACLE
from vellumflow.session import scratch
from vellumflow.sources import feed

T0 = datetime(2024, 1, 1, 10, 0)
EVENTS = "event_id long, user_id string, ts timestamp, cost double"


@pytest.mark.parametrize("name", ["request_bursts", "budget_by_user", "budget_by_agent", "table_changes", "replayed_changes"])
def test_sql(spark, con, sf, name):
    count, difference = compare(registry.QUERIES[name](spark, sf), con, ORACLE[name])
    assert difference is None and count > 0


def test_a_burst_over_the_full_hour(spark):
    """Three requests from 10:55 to 11:10 are over a limit of two an hour, though no clock hour holds three."""
    log = [(k, "u", T0 + timedelta(minutes=m), 1.0) for k, m in enumerate((55, 65, 70, 115, 200))]
    got = limits.bursts(spark.createDataFrame(log, EVENTS), "user_id", "ts", "event_id", 2, 3600)
    assert rows(got, "event_id", "since") == [(2, log[0][2]), (3, log[1][2])]
    assert rows(limits.burst_spans(spark.createDataFrame(log, EVENTS), "user_id", "ts", "event_id", 2, 3600), "user_id", "events") == [("u", 2)]


def test_against_plain_with_a_hot_user(spark):
    rng = random.Random(3)
    log = []
    for k in range(600):
        user = "hot" if k % 3 == 0 else rng.choice(["a", "b", "c", None])
        when = None if k % 97 == 0 else T0 + timedelta(seconds=rng.choice([rng.randint(0, 40_000), 600 * rng.randint(0, 60)]))
        log.append((k, user, when, rng.choice([None, 1.0, 2.0])))
    df = spark.createDataFrame(log, EVENTS).repartition(3)
    usable = sorted((r for r in log if r[1] and r[2]), key=lambda r: (r[1], r[2], r[0]))
    for limit, seconds in ((1, 60), (3, 600), (10, 3600)):
        by_user = {}
        want = []
        for k, user, when, _ in usable:
            own = by_user.setdefault(user, [])
            own.append(when)
            if len(own) > limit and when - own[-1 - limit] < timedelta(seconds=seconds):
                want.append((k, own[-1 - limit]))
        assert rows(limits.bursts(df, "user_id", "ts", "event_id", limit, seconds), "event_id", "since") == sorted(want, key=repr)
    want = []
    for k, user, when, _ in usable:
        spent = sum(c or 0 for _, u, w, c in usable if u == user and timedelta(0) <= when - w < timedelta(seconds=900))
        if spent > 12:
            want.append((k, spent))
    assert want and rows(limits.over_budget(df, "user_id", "ts", "event_id", "cost", 12, 900), "event_id", "spent") == sorted(want, key=repr)


TABLE = "id long, name string, n long"


def test_changes_and_replay(spark):
    v0 = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", None), (4, "d", 4)], TABLE)
    v1 = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, None, 3), (5, "e", 5)], TABLE)
    v2 = spark.createDataFrame([(2, "b", None), (3, None, 3), (4, "back", 4), (5, "e", 6)], TABLE)
    first, second = feed.table_changes(v0, v1, ["id"], 1), feed.table_changes(v1, v2, ["id"], 2)
    assert rows(first, "id", "change_type") == sorted(
        [(2, "update_before"), (2, "update_after"), (3, "update_before"), (3, "update_after"), (4, "delete"), (5, "insert")], key=repr
    )
    log = feed.ChangeFeed(spark, scratch(spark, "feed"), v0.schema)
    for changes in (first, second, second):
        log.write(changes)
    assert rows(feed.replay(v0, log.read(1), ["id"]), "id", "name", "n") == rows(v2, "id", "name", "n")
    assert rows(feed.replay(v0, log.read(1, 1), ["id"]), "id", "name", "n") == rows(v1, "id", "name", "n")
    assert rows(feed.replay(v1, log.read(2), ["id"]), "id", "name", "n") == rows(v2, "id", "name", "n")
    assert feed.table_changes(v2, v2, ["id"], 3).count() == 0
    told = {(r["id"], r["change_version"]): r["columns"] for r in feed.changed_columns(log.read(1), ["id"]).collect()}
    assert told == {(2, 1): ["name", "n"], (3, 1): ["name", "n"], (5, 2): ["n"]}
    empty = v0.limit(0)
    assert rows(feed.table_changes(empty, v0, ["id"], 1), "change_type") == [("insert",)] * 4
    assert rows(feed.replay(v0, feed.table_changes(v0, empty, ["id"], 1), ["id"]), "id") == []


def test_feed_as_a_stream(spark):
    """From a version on; a version written while the stream is away comes with the next run."""
    v = [spark.createDataFrame([(k, "x", n) for k in range(3 + n)], TABLE) for n in range(4)]
    log = feed.ChangeFeed(spark, scratch(spark, "feed"), v[0].schema)
    out, state = scratch(spark, "out"), scratch(spark, "state")

    def run():
        query = log.stream(since=2).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()

    log.write(feed.table_changes(v[0], v[1], ["id"], 1))
    log.write(feed.table_changes(v[1], v[2], ["id"], 2))
    run()
    log.write(feed.table_changes(v[2], v[3], ["id"], 3))
    run()
    seen = spark.read.parquet(out)
    assert rows(seen.select("change_version").distinct(), "change_version") == [(2,), (3,)]
    assert rows(feed.replay(v[1], seen, ["id"]), "id", "n") == rows(v[3], "id", "n")


def test_budget_sums_are_not_made_anew_for_each_row(spark):
    """Frames begin at the first row of their slice: a sliding one costs the square of a slice's events."""
    costs = [(0, 1e18), (30, 0.25), (59, None), (60, 0.25), (61, 0.5), (119, 0.5), (120, 0.5), (120, 0.25), (200, 1.0)]
    log = [(k, "u", T0 + timedelta(seconds=s), c) for k, (s, c) in enumerate(costs)]
    got = limits.over_budget(spark.createDataFrame(log, EVENTS), "user_id", "ts", "event_id", "cost", 0.9, 60)
    assert rows(got, "event_id", "spent") == [(0, 1e18), (1, 1e18), (2, 1e18), (4, 1.0), (5, 1.25), (6, 1.75), (7, 1.75), (8, 1.0)]
    assert "unboundedpreceding" in (plan := got._jdf.queryExecution().executedPlan().toString()) and not re.search(r"RangeFrame, -\d{3}", plan)
    exact = spark.createDataFrame(log, EVENTS).withColumn("cost", F.when(F.col("cost") < 10, F.col("cost")).cast("decimal(10,4)"))
    assert dict(limits.over_budget(exact, "user_id", "ts", "event_id", "cost", 0.9, 60).dtypes)["spent"] == "decimal(24,4)"
