"""Intermediate tables in the shared work folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vellumflow.session import scratch


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: what follows costs a lost executor its own tasks only."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
