"""Replies to a batch in which each message sees what its user's earlier messages did.

A message with text that finds a workflow of its user takes the workflow's next step and is answered
with it; one that finds none goes by its intent, and a request with a document path starts
a workflow. The log of job events stands still during a batch, so a workflow is a short ladder of
steps known beforehand: it is cleared after one, two or three messages, or waits for a job for
ever. What a message needs to know of its user is therefore small: the workflow, the steps taken
and the steps left.

Messages are dealt over tasks in ranges of (user, time, id), so a user with very many messages
lies in many ranges, in order. All users but the first of a range begin in it, and their messages are
decided there. Those of the first user are decided for each of the five numbers of steps that
earlier ranges may leave, and the range as a whole becomes a map from steps left before to the
workflow and steps left after it. These maps, at most two for each range, are composed in the order of the
ranges, which gives each range its start and picks one of the five.

Messages without text change nothing. Messages without a user see no workflow and leave none. Rows
may be repeated; each is a message. At equal times the smaller event id comes first, null first.
A run that the batch starts and the log does not know yet counts as just started.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vellumflow import vocabulary as V
from vellumflow.functions.text import classify_intent, document_path
from vellumflow.functions.times import instant
from vellumflow.operators.joins import lookup
from vellumflow.operators.latest import latest_event, pending_workflow
from vellumflow.operators.status import status_of
from vellumflow.operators.workflow import decide
from vellumflow.plans.routing import answered, step_reply
from vellumflow.sources.staging import staged

# Executors need not have this package: the task function travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Steps left of a workflow that waits for a job: it takes any number of messages.
FOREVER = 9
#: The numbers of steps that may be left, none included.
LEFT = (0, 1, 2, 3, FOREVER)
#: Messages of one range, on average.
RANGE_ROWS = 200_000
EMPTY, PLAIN, START = 0, 1, 2


# --- workflows as ladders ----------------------------------------------------------------------


def _ladders(origins: DataFrame, ev: DataFrame, next_run: Column, as_of: datetime | None) -> DataFrame:
    """``origins`` (key, current_stage, extraction_run_id, summarization_run_id, fresh) with the statuses
    of both runs, the rung on which each workflow begins, the one on which it ends, and its steps."""
    jobs = ev.filter(F.col("agent").isin(V.EXTRACTION.name, V.SUMMARIZATION.name) & (F.col("run_id") != V.NO_RUN))
    newest = staged(latest_event(jobs.select("run_id", "agent", "event_type", "timestamp", "event_id")), "newest")
    stage = F.col("current_stage")
    started = stage == V.EXTRACTING  # its summarization, if any, begins in this batch
    rows = origins.withColumn("summarization_run_id", F.when(started, next_run).otherwise(F.col("summarization_run_id")))
    for agent, run, kind in ((V.EXTRACTION, "extraction_run_id", "e"), (V.SUMMARIZATION, "summarization_run_id", "s")):
        mine = newest.where(F.col("agent") == agent.name).select(
            F.col("run_id").alias(run), F.col("event_type").alias(f"{kind}_event"), F.col("timestamp").alias(f"{kind}_at")
        )
        rows = lookup(rows, mine, [run], spread_by="key")
        new = F.col(f"{kind}_event").isNull() & (F.col("fresh") if kind == "e" else started)
        rows = rows.withColumn(f"{kind}_status", F.when(new, "RUNNING").otherwise(status_of(F.col(f"{kind}_event"), agent)))
        rows = rows.withColumn(f"{kind}_at", F.when(new, instant(as_of)).otherwise(F.col(f"{kind}_at")))
    begins = F.when(started, 0).when(stage == V.SUMMARIZING, 1).when(stage == V.DONE, 2).otherwise(3)
    ends = (
        F.when(begins >= 2, begins)
        .when((begins == 0) & (F.col("e_status") != "COMPLETED"), 0)
        .when(F.col("s_status") != "COMPLETED", 1)
        .otherwise(2)
    )
    # On its last rung a workflow is cleared, or waits for ever.
    cleared = (F.col("ends") == 2) | ((F.col("ends") == 0) & (F.col("e_status") == "FAILED")) | ((F.col("ends") == 1) & (F.col("s_status") == "FAILED"))
    rows = rows.withColumns({"begins": begins, "ends": ends})
    return rows.withColumn("steps", F.when(cleared, F.col("ends") - F.col("begins") + 1).otherwise(FOREVER))


# --- the fold ---------------------------------------------------------------------------------------

STATE = "origin long, same boolean, taken int, steps int"
FOUND = "busy boolean, origin long, same boolean, taken int"


def _fold(rows: DataFrame) -> DataFrame:
    """Messages (m, user, kind, starts, steps) in order of user and time, folded per range.

    Result rows: a message with what it ``found``, one candidate or one for each of ``LEFT``; and for the first and last
    user of a range a row without message, with the state ``after`` the range for each of ``LEFT``.
    """

    def step(state: tuple, m: int, kind: int, starts: int) -> tuple:
        origin, same, taken, left = state
        if kind == EMPTY:
            return state
        if left:
            left = left if left == FOREVER else left - 1
            return (origin, same, min(taken + 1, 3), left) if left else (None, False, 0, 0)
        return (m, False, 0, starts) if kind == START else state

    def seen(state: tuple) -> dict:
        return {"busy": state[3] > 0, "origin": state[0], "same": state[1], "taken": state[2]}

    def as_state(state: tuple) -> dict:
        return dict(zip(("origin", "same", "taken", "steps"), state))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user, first, begun, states, number = None, True, None, None, None

        def summary() -> dict:
            after = [as_state(s) for s in (states if len(states) > 1 else states * len(LEFT))]
            return {"range": number, "user": user, "first": first, "begun": begun, "m": None, "found": None, "after": after}

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                number = r["range"]
                if states is None or r["user"] != user:
                    if states is not None:
                        if first and user is not None:
                            out.append(summary())
                        first = False
                    user, begun = r["user"], r["steps"]
                    known = (None, False, 0, begun or 0)
                    # The first user of a range may have messages in earlier ranges.
                    states = [(None, True, 0, left) for left in LEFT] if first and user is not None else [known]
                out.append({"range": number, "user": user, "first": first, "begun": None, "m": r["m"], "found": [seen(s) for s in states], "after": None})
                if user is not None:
                    states = [step(s, r["m"], r["kind"], r["starts"]) for s in states]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if states is not None and user is not None:
            yield pa.RecordBatch.from_pylist([summary()], schema=schema)

    state = pa.struct([("origin", pa.int64()), ("same", pa.bool_()), ("taken", pa.int32()), ("steps", pa.int32())])
    found = pa.struct([("busy", pa.bool_()), ("origin", pa.int64()), ("same", pa.bool_()), ("taken", pa.int32())])
    text = pa.string()
    schema = pa.schema([
        ("range", pa.int32()), ("user", text), ("first", pa.bool_()), ("begun", pa.int32()), ("m", pa.int64()), ("found", pa.list_(found)), ("after", pa.list_(state)),
    ])
    ddl = f"range int, user string, first boolean, begun int, m long, found array<struct<{_typed(FOUND)}>>, after array<struct<{_typed(STATE)}>>"
    return rows.mapInArrow(task, ddl)


def _typed(fields: str) -> str:
    return ", ".join(f.replace(" ", ": ", 1) for f in fields.split(", "))


def _at(candidates: Column, steps: Column) -> Column:
    """The candidate for a number of steps left."""
    return F.get(candidates, F.when(steps == FOREVER, len(LEFT) - 1).otherwise(steps))


def _starts_of_ranges(folded: DataFrame) -> DataFrame:
    """(range, before): the state that the first user of a range brings along, by composing the maps of
    the ranges before; a user has one row for each range."""
    maps = folded.where("m IS NULL")
    kind = f"struct<{_typed(STATE)}>"
    earlier = Window.partitionBy("user").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.struct(F.lit(None).cast("long").alias("origin"), F.lit(False).alias("same"), F.lit(0).alias("taken"), F.coalesce("begun", F.lit(0)).alias("steps"))

    def compose(state: Column, after: Column) -> Column:
        to = _at(after, state["steps"])
        return F.struct(
            F.when(to["same"], state["origin"]).otherwise(to["origin"]).alias("origin"), F.lit(False).alias("same"),
            F.when(to["same"], F.least(state["taken"] + to["taken"], F.lit(3))).otherwise(to["taken"]).alias("taken"), to["steps"].alias("steps"),
        ).cast(kind)

    listed = maps.select("range", "first", "begun", F.collect_list("after").over(earlier).alias("maps"))
    return listed.where("first").select("range", F.aggregate("maps", begun.cast(kind), compose).alias("before"))


def _found(messages: DataFrame) -> DataFrame:
    """(m, busy, origin, taken): whether each message finds a workflow, which (the starting message, or null
    for the one before the batch), and how many steps were taken before."""
    n = messages.count()
    ranged = messages.repartitionByRange(max(1, -(-n // RANGE_ROWS)), "user", "ts", "event_id", "m").withColumn("range", F.spark_partition_id())
    folded = staged(_fold(ranged.sortWithinPartitions("user", "ts", "event_id", "m").select("range", "user", "m", "kind", "starts", "steps")), "folded")
    mine = folded.where("m IS NOT NULL")
    decided = mine.where("size(found) = 1").select("m", F.col("found")[0]["busy"].alias("busy"), F.col("found")[0]["origin"].alias("origin"), F.col("found")[0]["taken"].alias("taken"))
    open_ = lookup(mine.where("size(found) > 1"), _starts_of_ranges(folded), ["range"], "inner")
    pick, before = _at(F.col("found"), F.col("before.steps")), F.col("before")
    picked = open_.select(
        "m", pick["busy"].alias("busy"), F.when(pick["same"], before["origin"]).otherwise(pick["origin"]).alias("origin"),
        F.when(pick["same"], F.least(before["taken"] + pick["taken"], F.lit(3))).otherwise(pick["taken"]).alias("taken"),
    )
    return decided.unionByName(picked)


# --- replies ---------------------------------------------------------------------------------------


def route_in_order(
    messages: DataFrame, st: DataFrame, ev: DataFrame, site_url: str, new_run: Column, next_run: Column,
    as_of: datetime | None = None, hours: int = 2, knowledge: DataFrame | None = None,
) -> DataFrame:
    """Route and answer each message (event_id, user_id, ts, content) in order of its user's messages.

    ``new_run`` is the run id given to an extraction that a message starts, ``next_run`` that of the
    summarization after ``extraction_run_id``. ``knowledge`` holds ready search replies as (event_id, reply).
    """
    content = F.col("content")
    asked = messages.select("event_id", "user_id", "ts", "content").withColumns(
        {"intent": classify_intent(content), "path": document_path(content), "m": F.monotonically_increasing_id()}
    )
    asked = staged(asked.withColumn("new_run", new_run.cast("long")), "asked")
    begins = (F.col("intent") == "extract_document") & F.col("path").isNotNull()
    before = pending_workflow(st, as_of, hours).select(
        F.concat(F.lit("u"), "user_id").alias("key"), "current_stage", "extraction_run_id", "summarization_run_id", F.lit(False).alias("fresh")
    )
    during = asked.where(begins).select(
        F.concat(F.lit("m"), F.col("m").cast("string")).alias("key"), F.lit(V.EXTRACTING).alias("current_stage"), F.col("new_run").alias("extraction_run_id"),
        F.lit(None).cast("long").alias("summarization_run_id"), F.lit(True).alias("fresh"),
    )
    ladders = staged(_ladders(before.unionByName(during), ev, next_run, as_of), "ladders")
    steps = ladders.select("key", "steps")
    kind = F.when(F.coalesce(content, F.lit("")) == "", EMPTY).when(begins, START).otherwise(PLAIN)
    narrow = asked.select("event_id", "user_id", "ts", "m", kind.alias("kind"), F.concat(F.lit("u"), "user_id").alias("key"))
    narrow = lookup(narrow, steps, ["key"], spread_by="m").withColumn("key", F.when(F.col("kind") == START, F.concat(F.lit("m"), F.col("m").cast("string"))))
    narrow = lookup(narrow, steps.withColumnRenamed("steps", "starts"), ["key"], spread_by="m")
    narrow = narrow.select("event_id", F.col("user_id").cast("string").alias("user"), "ts", "m", "kind", F.coalesce("starts", F.lit(0)).alias("starts"), "steps")
    key = F.when(F.col("busy"), F.coalesce(F.concat(F.lit("m"), F.col("origin").cast("string")), F.concat(F.lit("u"), "user_id")))
    found = lookup(asked, _found(narrow), ["m"]).withColumn("key", key)
    rows = lookup(found, ladders, ["key"], spread_by="m")
    rung = F.least(F.col("begins") + F.col("taken"), F.col("ends"))
    rows = rows.withColumn("rung", rung).withColumn(
        "current_stage", F.when(F.col("rung") == 0, V.EXTRACTING).when(F.col("rung") == 1, V.SUMMARIZING).when(F.col("rung") == 2, V.DONE).otherwise(F.col("current_stage"))
    ).withColumns({
        "run_status": F.when(F.col("rung") == 0, F.col("e_status")).when(F.col("rung") == 1, F.col("s_status")),
        "event_at": F.when(F.col("rung") == 0, F.col("e_at")).when(F.col("rung") == 1, F.col("s_at")),
        "status": F.lit(V.IN_PROGRESS),
    })
    decided = decide(rows)
    answers = decided.withColumns({
        "workflow_reply": F.when(F.col("key").isNotNull(), step_reply(site_url, next_run, as_of)), "action": F.when(F.col("key").isNotNull(), F.col("action"))
    })
    if knowledge is None:
        answers = answers.withColumn("found", F.lit(None).cast("string"))
    else:
        answers = answers.join(knowledge.select("event_id", F.col("reply").alias("found")), "event_id", "left")
    return answered(answers, F.col("new_run"))
