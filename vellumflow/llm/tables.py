"""Intermediate tables in the shared work folder, deleted once what follows is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellumflow.session import scratch


class Tables:
    """Tables that cut a job's lineage; a lost executor costs its own tasks only."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read back."""
        path = scratch(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self, since: int = 0) -> None:
        """Delete the tables kept from number ``since`` on; none may be read any more."""
        for path in self.paths[since:]:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
        del self.paths[since:]
