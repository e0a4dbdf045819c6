"""Hot row store and cold event log: lookup, union, drift, retention."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions.times import instant
from vellumflow.operators.latest import newest_per


def cold_status(ev: DataFrame) -> DataFrame:
    """Newest event of each run, keyed like the hot store by text run id."""
    # Cast first: grouping then leaves the rows where the join needs them.
    keyed = ev.withColumn("run_id", F.col("run_id").cast("string"))
    newest = newest_per(keyed, ["run_id"], "timestamp", "event_id", ["status", "timestamp", "sp_used"])
    return newest.select(
        "run_id",
        F.col("status").alias("cold_status"),
        F.col("timestamp").alias("cold_updated_at"),
        F.col("sp_used").alias("cold_sp_used"),
    )


HOT_COLUMNS = [
    "run_id", "user_id", "conversation_id", "job_type", "agent", "status", "sp_used", "created_at", "updated_at"
]


def upsert_status(hot: DataFrame, changes: DataFrame) -> DataFrame:
    """The hot store after inserts and updates, as a whole new table.

    The newest ``updated_at`` of a run wins; a change that is not given a value
    keeps the old one, and ``created_at`` stays the earliest. At equal times a later
    state wins (pending, running, finished), then the greater other columns.
    """
    both = hot.select(*HOT_COLUMNS).unionByName(changes.select(*HOT_COLUMNS))
    state = F.when(F.col("status") == "PENDING", 0).when(F.col("status") == "RUNNING", 1).otherwise(2)
    order = F.struct("updated_at", state, "status", *[c for c in HOT_COLUMNS if c not in ("run_id", "updated_at", "status")])

    def newest(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), order)).alias(column)

    kept = [c for c in HOT_COLUMNS if c not in ("run_id", "created_at")]
    return both.groupBy("run_id").agg(*[newest(c) for c in kept], F.min("created_at").alias("created_at")).select(*HOT_COLUMNS)


def delete_status(hot: DataFrame, run_ids: DataFrame) -> DataFrame:
    """The hot store without the given runs."""
    return hot.join(run_ids.select(F.col("run_id").cast("string").alias("run_id")), "run_id", "left_anti")


def _hot(hot: DataFrame) -> DataFrame:
    return hot.select(
        "run_id", "status", "updated_at", "sp_used", F.lit(True).alias("in_hot")
    )


def _merged(name: str) -> Column:
    return F.when(F.col("in_hot"), F.col(name)).otherwise(F.col(f"cold_{name}")).alias(name)


def lookup_status(requested: DataFrame, hot: DataFrame, ev: DataFrame) -> DataFrame:
    """Status of each requested run: the hot row if there is one, else the
    newest cold event, else none."""
    wanted = requested.select(F.col("run_id").cast("string").alias("run_id")).distinct()
    joined = wanted.join(_hot(hot), "run_id", "left").join(cold_status(ev), "run_id", "left")
    source = F.when(F.col("in_hot"), "hot").when(F.col("cold_updated_at").isNotNull(), "cold")
    return joined.select("run_id", source.alias("source"), _merged("status"), _merged("updated_at"), _merged("sp_used"))


def hot_lookup(requested: DataFrame, hot: DataFrame) -> DataFrame:
    """Key lookup in the hot store alone."""
    wanted = requested.select(F.col("run_id").cast("string").alias("run_id")).distinct()
    return hot.join(wanted, "run_id", "left_semi").select("run_id", "status", "updated_at", "sp_used")


def unified_status(hot: DataFrame, ev: DataFrame) -> DataFrame:
    """Every run of either tier once; the hot row wins."""
    joined = _hot(hot).join(cold_status(ev), "run_id", "full_outer")
    source = F.when(F.col("in_hot"), "hot").otherwise("cold")
    return joined.select("run_id", _merged("status"), _merged("updated_at"), _merged("sp_used"), source.alias("source"))


def tier_drift(hot: DataFrame, ev: DataFrame) -> DataFrame:
    """Hot runs that the cold tier lacks or reports differently."""
    joined = _hot(hot).join(cold_status(ev), "run_id", "left")
    missing = F.col("cold_updated_at").isNull()
    differs = ~F.col("status").eqNullSafe(F.col("cold_status"))
    return joined.filter(missing | differs).select(
        "run_id", "status", "cold_status",
        F.when(missing, "missing").otherwise("differs").alias("drift"),
    )


def expired(as_of: datetime | None, days: int) -> Column:
    """Finished and older than the retention; NULL times are never expired."""
    rule = F.col("status").isin(*V.FINISHED_JOB_STATUSES) & (
        F.col("updated_at") < instant(as_of, timedelta(days=days))
    )
    return F.coalesce(rule, F.lit(False))


def split_archive(hot: DataFrame, as_of: datetime | None = None, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """(archived, kept) parts of the hot store; together they are all of it."""
    rule = expired(as_of, days)
    return hot.filter(rule), hot.filter(~rule)
