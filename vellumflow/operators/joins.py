"""Joins of a table with many rows per key to one with a single row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

NULL_LANES = 1024
LANE = "_lane"


def stand_in(run: Column, spread_by: str) -> Column:
    """The run id, or for NULL a negative number that differs by row: it matches
    no run, and rows without a run do not meet in one shuffle partition."""
    return F.coalesce(run, -1 - F.pmod(F.xxhash64(spread_by), F.lit(1 << 40)))


def lookup(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", spread_by: str | None = None) -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per key.

    The left side may hold a third of its rows under one key, or without a key.
    Spark splits such a partition at run time only when both inputs come
    straight from a shuffle made for the join. The right side is usually
    grouped by the same key and would be joined in place, so both sides get one
    more key column, the lane, that its grouping does not cover. The lane is 0
    for every row with a key; rows with a NULL key match nothing, and with
    ``spread_by`` they are dealt over many lanes instead of one partition.
    """
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    # Always 0, but not a constant to the optimizer, which would drop the lane.
    zero = F.pmod(F.xxhash64(*on), F.lit(1))
    lane = zero if spread_by is None else F.when(keyed, zero).otherwise(1 + F.pmod(F.xxhash64(spread_by), F.lit(NULL_LANES)))
    joined = left.withColumn(LANE, lane).join(right.withColumn(LANE, zero), [*on, LANE], how).drop(LANE)
    return joined.select(*left.columns, *[c for c in joined.columns if c not in left.columns])
