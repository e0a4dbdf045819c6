"""Limits over any interval: bursts of requests and sums of cost in the time before each event.

Windows do not start at full hours: each event looks back by the whole interval. Time is cut
into slices as long as the interval, so what an event looks back on lies in its own slice and the
one before; each event is therefore given to its own slice and the next one, and a key with very many
events is as many groups as it has slices, none of which spans its history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

MICROS = 1_000_000


def _micros(ts: Column) -> Column:
    """Microseconds of a time in its own zone."""
    return F.unix_micros(ts.cast("timestamp"))


def sliced(rows: DataFrame, ts: str, seconds: int) -> DataFrame:
    """``rows`` with ``_at`` (microseconds), in their own slice (``_own``) and the next one."""
    at = _micros(F.col(ts))
    slice_ = F.floor(at / F.lit(seconds * MICROS)).cast("long")
    placed = rows.where(F.col(ts).isNotNull()).withColumns({"_at": at, "_born": slice_})
    return placed.withColumn("_slice", F.explode(F.array("_born", F.col("_born") + 1))).withColumn("_own", F.col("_slice") == F.col("_born"))


def bursts(rows: DataFrame, key: str, ts: str, event_id: str, limit: int, seconds: int) -> DataFrame:
    """(key, event_id, ts, since): events with more than ``limit`` events of their key, themselves
    included, in the ``seconds`` up to them; ``since`` is the time of the event ``limit`` places before.

    An event exactly ``seconds`` older does not count any more. At equal times the order is that of the ids.
    Rows without key or time are left out.
    """
    narrow = rows.select(key, ts, event_id).where(F.col(key).isNotNull())
    order = Window.partitionBy(key, "_slice").orderBy("_at", event_id)
    seen = sliced(narrow, ts, seconds).withColumns({"since": F.lag(ts, limit).over(order), "_since": F.lag("_at", limit).over(order)})
    over = F.col("_own") & (F.col("_at") - F.col("_since") < seconds * MICROS)
    return seen.where(over).select(key, event_id, ts, "since")


def burst_spans(rows: DataFrame, key: str, ts: str, event_id: str, limit: int, seconds: int) -> DataFrame:
    """(key, first_ts, last_ts, events): per key the span and number of its events over the limit."""
    return bursts(rows, key, ts, event_id, limit, seconds).groupBy(key).agg(
        F.min("since").alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("events")
    )


def over_budget(rows: DataFrame, key: str, ts: str, event_id: str, cost: str, budget: float, seconds: int) -> DataFrame:
    """(key, event_id, ts, spent): events whose key spent more than ``budget`` in the ``seconds`` up to
    them, the event and those of its very moment included, one exactly ``seconds`` older not; a missing cost is 0."""
    narrow = rows.select(key, ts, event_id, cost).where(F.col(key).isNotNull())
    paid, width = F.coalesce(F.col(cost), F.lit(0)), seconds * MICROS
    kind = narrow.select(F.sum(paid)).schema[0].dataType
    # The interval is what its own slice has up to the event, and what the slice before has after the interval's
    # start: two running sums, neither of which is taken back. A frame that slides would be summed anew for each row.
    moved = sliced(narrow, ts, seconds).withColumn("_at", F.when(F.col("_own"), F.col("_at")).otherwise(F.col("_at") + width))
    slice_ = Window.partitionBy(key, "_slice")
    upto = slice_.orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    after = slice_.orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, -1)
    sums = moved.withColumns({"_upto": F.sum(F.when(F.col("_own"), paid)).over(upto), "_after": F.sum(F.when(~F.col("_own"), paid)).over(after)})
    spent = sums.where("_own").withColumn("spent", F.coalesce(F.col("_upto") + F.col("_after"), F.col("_upto")).cast(kind))
    return spent.where(F.col("spent") > budget).select(key, event_id, ts, "spent")
