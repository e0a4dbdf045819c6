"""Streams that act when time runs out: silent runs and bursts, with a timer per run and time slice.

State is kept per key until the watermark passes its timer and then emitted and dropped. What a
finite log leaves below the watermark is still in the state, and is read from there instead of
from the log. Both streams set the session's state store to RocksDB, which timers need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor

from vellumflow import vocabulary as V
from vellumflow.operators.limits import MICROS, sliced
from vellumflow.session import keep_state_in_rocksdb
from vellumflow.streaming.streams import with_event_time

SESSION = "begin long, end long, last_start long, last_end long"
EVENTS = "array<struct<key string, at long, event_id string, own boolean>>"
#: An element of the state of bursts: the events of a group in one batch, as a JSON array.
PACKED = "events string"
#: Groups of keys in a slice; a key's events stay together. A call per key and slice would cost more than the events.
GROUPS = 32


def _session_processor(timeout_ms: int) -> StatefulProcessor:
    """Within a function, so that executors need not have this package."""
    schema, silence = SESSION, timeout_ms * 1000

    def later(a, b):
        return max((x for x in (a, b) if x is not None), default=None)

    def silent(last_start, last_end):
        return last_start is not None and (last_end is None or last_end < last_start)

    class Sessions(StatefulProcessor):
        """Sessions of one run that are still open; each ends a timeout after its last event."""

        def init(self, handle):
            self.handle = handle
            self.sessions = handle.getListState("sessions", schema)

        def handleInputRows(self, key, rows, timerValues):
            held = [tuple(s) for s in self.sessions.get()] if self.sessions.exists() else []
            held += [(r["at"], r["at"] + silence, r["at"] if r["started"] else None, r["at"] if r["ended"] else None) for r in rows]
            merged = []
            for begin, end, start, stop in sorted(held, key=lambda s: s[:2]):
                if merged and begin < merged[-1][1]:
                    last = merged[-1]
                    merged[-1] = (last[0], max(last[1], end), later(last[2], start), later(last[3], stop))
                else:
                    merged.append((begin, end, start, stop))
            self.sessions.put(merged)
            for session in merged:
                self.handle.registerTimer(-(-session[1] // 1000))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = expiredTimerInfo.getExpiryTimeInMs() * 1000
            # Empty where another timer of the run has cleared it, or an event has put the end off.
            held = [tuple(s) for s in self.sessions.get()] if self.sessions.exists() else []
            open_ = [s for s in held if s[1] > now]
            if len(open_) < len(held):
                self.sessions.put(open_) if open_ else self.sessions.clear()
            for begin, end, start, stop in held:
                if end <= now and silent(start, stop):
                    yield Row(run_id=key[0], started_at=start, gave_up_at=end)

        def close(self):
            pass

    return Sessions()


def _times(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: F.timestamp_micros(n) for n in names})


def silent_runs(ev: DataFrame, agent: V.Agent, watermark: str = "1 day") -> DataFrame:
    """(run_id, started_at, gave_up_at): runs of one agent that started and then fell silent for the job timeout,
    each when its timer fires. An event exactly at the timeout comes too late. State per run: its sessions not older
    than the watermark."""
    keep_state_in_rocksdb(ev.sparkSession)
    kind = F.col("event_type")
    mine = with_event_time(ev.filter((F.col("agent") == agent.name) & (F.col("run_id") != V.NO_RUN)), watermark)
    rows = mine.select(
        "run_id", "timestamp", F.unix_micros("timestamp").alias("at"),
        kind.endswith("Started").alias("started"), kind.isin(agent.completed, agent.failed).alias("ended"),
    ).where("run_id IS NOT NULL")
    found = rows.groupBy("run_id").transformWithState(
        _session_processor(agent.timeout_minutes * 60_000), "run_id long, started_at long, gave_up_at long", "Append", "EventTime"
    )
    return _times(found, "started_at", "gave_up_at")


def held_silent_runs(spark: SparkSession, checkpoint: str, agent: V.Agent) -> DataFrame:
    """What the timers of :func:`silent_runs` hold back when its stream has ended: sessions in its state whose
    timeout is over at the newest event. That event's own session is always among those held."""
    state = spark.read.format("statestore").option("stateVarName", "sessions").load(checkpoint)
    held = state.select(F.col("key.run_id").alias("run_id"), "list_element.*")
    newest = held.agg(F.max("end")).first()[0]
    if newest is None:
        return _times(held.select("run_id", F.col("last_start").alias("started_at"), F.col("end").alias("gave_up_at")), "started_at", "gave_up_at")
    until = newest - agent.timeout_minutes * 60 * MICROS
    late = held.where((F.col("end") <= until) & F.col("last_start").isNotNull() & F.coalesce(F.col("last_end") < F.col("last_start"), F.lit(True)))
    return _times(late.select("run_id", F.col("last_start").alias("started_at"), F.col("end").alias("gave_up_at")), "started_at", "gave_up_at")


def _burst_processor(limit: int, seconds: int) -> StatefulProcessor:
    schema, width = PACKED, seconds * MICROS

    class Bursts(StatefulProcessor):
        """The events of a group of keys in one slice of time and the slice before, until the slice is over."""

        def init(self, handle):
            self.handle = handle
            self.events = handle.getListState("events", schema)

        def handleInputRows(self, key, rows, timerValues):
            # One element for all rows of a batch: a call per event would cost far more than the event.
            self.events.appendList([(f"[{','.join(part['event'])}]",) for part in rows])
            self.handle.registerTimer((key[1] + 1) * width // 1000)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            import json

            import pandas as pd

            def place(e):
                return e["key"], e["at"], "event_id" in e, e.get("event_id")

            events = sorted((e for part in self.events.get() for e in json.loads(part[0])), key=place)
            self.events.clear()
            found = []
            for i in range(limit, len(events)):
                event, before = events[i], events[i - limit]
                if event["own"] and event["key"] == before["key"] and event["at"] - before["at"] < width:
                    found.append((event["key"], event.get("event_id"), event["at"], before["at"]))
            if found:
                yield pd.DataFrame(found, columns=["key", "event_id", "at", "since"])

        def close(self):
            pass

    return Bursts()


def bursts(rows: DataFrame, key: str, ts: str, event_id: str, limit: int, seconds: int, watermark: str = "1 day", groups: int = GROUPS) -> DataFrame:
    """(key, event_id, at, since): the rows of :func:`vellumflow.operators.limits.bursts`, each when its slice is over.

    Events lie in slices as long as the interval, so a busy key is as many groups as it has slices, and state
    holds the slices that the watermark has not passed. In a slice, keys are dealt into ``groups`` by their hash,
    and a group is handled at once. Keys and ids are text.
    """
    keep_state_in_rocksdb(rows.sparkSession)
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark).where(F.col(key).isNotNull())
    placed = sliced(timed.select(ts, F.col(key).cast("string").alias("key"), F.col(event_id).cast("string").alias("event_id")), ts, seconds)
    event = F.to_json(F.struct("key", F.col("_at").alias("at"), "event_id", F.col("_own").alias("own")))
    narrow = placed.select(F.pmod(F.xxhash64("key"), F.lit(groups)).alias("_group"), "_slice", ts, event.alias("event"))
    found = narrow.groupBy("_group", "_slice").transformWithStateInPandas(
        _burst_processor(limit, seconds), "key string, event_id string, at long, since long", "Append", "EventTime"
    )
    return _times(found, "at", "since")


def held_bursts(spark: SparkSession, checkpoint: str, limit: int, seconds: int) -> DataFrame:
    """The bursts in slices that :func:`bursts` still holds when its stream has ended."""
    state = spark.read.format("statestore").option("stateVarName", "events").load(checkpoint)
    parts = state.select(F.col("key._slice").alias("_slice"), F.explode(F.from_json("list_element.events", EVENTS)).alias("e"))
    held = parts.select("_slice", "e.*")
    order = Window.partitionBy("key", "_slice").orderBy("at", "event_id")
    seen = held.withColumn("since", F.lag("at", limit).over(order))
    return _times(seen.where(F.col("own") & (F.col("at") - F.col("since") < seconds * MICROS)).select("key", "event_id", "at", "since"), "at", "since")
