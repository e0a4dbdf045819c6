"""Row-level changes between versions of a keyed table, as a table and as a stream.

A change is an insert, a delete, or an update, which is two rows: the row before and the row after.
Rows are compared by a digest of all columns, so the wide rows of a table meet only where they
changed: first (key, digest) of both versions, then the changed rows of each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from vellumflow.operators.joins import lookup

CHANGE, VERSION = "change_type", "change_version"
INSERT, DELETE, BEFORE, AFTER = "insert", "delete", "update_before", "update_after"


def _digest(columns: list[str]) -> Column:
    """Two hashes of a row; which columns are null is hashed too, since a null value leaves a hash as it is."""
    nulls = [F.col(c).isNull() for c in columns]
    return F.struct(F.xxhash64(*columns, *nulls).alias("a"), F.xxhash64(F.lit(1), *nulls, *columns).alias("b"))


def table_changes(before: DataFrame, after: DataFrame, key: list[str], version: int) -> DataFrame:
    """What turns ``before`` into ``after``: the table's columns, ``change_type`` and ``change_version``.

    ``key`` names columns that are never null and unique in each version. Both have the same columns.
    """
    columns = before.columns
    rest = [c for c in columns if c not in key]
    sides = {s: df.select(*key, _digest(rest).alias(f"_{s}")) for s, df in (("old", before), ("new", after.select(*columns)))}
    both = sides["old"].join(sides["new"], key, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    changed = both.select(*key, F.col("_old").isNull().alias("_born"), F.col("_new").isNull().alias("_gone"))
    old = before.join(changed.where("NOT _born"), key).withColumn(CHANGE, F.when(F.col("_gone"), DELETE).otherwise(BEFORE))
    new = after.select(*columns).join(changed.where("NOT _gone"), key).withColumn(CHANGE, F.when(F.col("_born"), INSERT).otherwise(AFTER))
    return old.unionByName(new).select(*columns, CHANGE, F.lit(version).cast("long").alias(VERSION))


def replay(before: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """The table after ``changes`` of any number of versions: the last change of each key decides."""
    columns = before.columns
    decides = changes.where(F.col(CHANGE) != BEFORE)
    last = Window.partitionBy(*key).orderBy(F.desc(VERSION))
    newest = decides.withColumn("_place", F.row_number().over(last)).where("_place = 1")
    kept = before.join(newest.select(*key), key, "left_anti")
    return kept.unionByName(newest.where(F.col(CHANGE) != DELETE).select(*columns))


def _schema(table: T.StructType) -> T.StructType:
    return T.StructType([*table.fields, T.StructField(CHANGE, T.StringType()), T.StructField(VERSION, T.LongType())])


class ChangeFeed:
    """The changes of one table below a folder, one folder for each version; writing a version again
    replaces it, so a repeated job changes nothing."""

    def __init__(self, spark: SparkSession, path: str, table: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), _schema(table)

    def write(self, changes: DataFrame) -> None:
        """Changes of one or more versions."""
        rows = changes.select(*self.schema.fieldNames())
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VERSION).parquet(self.path)

    def read(self, since: int = 0, until: int | None = None) -> DataFrame:
        """Changes of the versions from ``since`` to ``until``, both included; only their folders are opened."""
        rows = self.spark.read.schema(self.schema).parquet(self.path).where(F.col(VERSION) >= since)
        return rows if until is None else rows.where(F.col(VERSION) <= until)

    def stream(self, since: int = 0) -> DataFrame:
        """The same as a stream, which goes on with versions written later."""
        return self.spark.readStream.schema(self.schema).parquet(self.path).where(F.col(VERSION) >= since)


def changed_columns(changes: DataFrame, key: list[str]) -> DataFrame:
    """(key, change_version, columns): which columns each update changed."""
    values = [c for c in changes.columns if c not in (*key, CHANGE, VERSION)]
    on = [*key, VERSION]
    before = changes.where(F.col(CHANGE) == BEFORE).select(*on, *[F.col(c).alias(f"_{c}") for c in values])
    both = lookup(changes.where(F.col(CHANGE) == AFTER), before, on, "inner")
    names = [F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in values]
    listed = reduce(lambda a, n: F.concat(a, F.when(n.isNotNull(), F.array(n)).otherwise(F.array().cast("array<string>"))), names, F.array().cast("array<string>"))
    return both.select(*on, listed.alias("columns"))
