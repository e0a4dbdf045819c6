"""Clock arithmetic that works alike for TIMESTAMP and TIMESTAMP_NTZ columns."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F


def instant(as_of: datetime | None, minus: timedelta = timedelta()) -> Column:
    """``as_of - minus``; ``None`` means the current time.

    A given ``as_of`` becomes a constant, so comparisons against it reach the
    parquet scan. One without a zone is in session time.
    """
    if as_of is None:
        return F.current_timestamp() - F.lit(minus)
    if as_of.tzinfo is not None:
        return F.lit(as_of - minus)
    return F.lit((as_of - minus).isoformat(sep=" ")).cast("timestamp_ntz")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with microseconds, as DECIMAL."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)")


def whole_seconds(later: Column, earlier: Column) -> Column:
    """Elapsed seconds without the fraction."""
    return (later - earlier).cast("interval second").cast("long")


def micros_between(later: Column, earlier: Column) -> Column:
    return (seconds_between(later, earlier) * 1_000_000).cast("long")


def whole_minutes(later: Column, earlier: Column) -> Column:
    """Completed minutes between two instants; days count in full."""
    return F.floor(seconds_between(later, earlier) / 60).cast("int")


def view_minutes(later: Column, earlier: Column) -> Column:
    """Minutes by whole epoch seconds on both sides, truncated."""
    return whole_minutes(F.date_trunc("second", later), F.date_trunc("second", earlier))


def iso_format(ts: Column) -> Column:
    """ISO text; the fraction appears only when it is not zero."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.000000$", "")


def compact_format(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")
