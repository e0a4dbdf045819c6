"""Whole-file text sources, directory listings and the text sink.

One row is one file. Files written by :func:`write_text_files` carry their name
in a ``file_name=`` folder and end with one line end more than their content, which
readers take off again; files from elsewhere keep their own base name and bytes.
Spark's file sources skip files of zero bytes; their names come from a listing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F

from vellumflow.functions.text import base_name, unix_lines


OWN_FILE = r"/file_name=([^/]+)/[^/]+$"
#: Spark lists folders by a task for each, up to this setting's 10,000; listing one takes far less than a task.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
TASKS_PER_CORE = 4
#: Spark counts 4 MB for opening a file, so it reads a few small files in each task; a task takes so many, or so many bytes.
TASK_FILES, TASK_BYTES = 256, 32 << 20
#: What Spark escapes in the names of partition folders, and its name for an empty or missing value.
ESCAPED = "[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]"
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def _unescaped(text: Column) -> Column:
    """Text whose special characters are written as % and two hexadecimal digits."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _file_name(path: Column) -> Column:
    """Name of a file from its plain path; folder names of the sink are escaped."""
    folder = F.regexp_extract(path, OWN_FILE, 1)
    return F.when(folder != "", _unescaped(folder)).otherwise(base_name(path))


def _listed(files: DataFrameReader, path: str) -> DataFrame:
    """``files`` below a folder, file or glob, listed by a few tasks per core."""
    spark = files._spark
    most, listing = spark.conf.get(LISTING_TASKS), str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    spark.conf.set(LISTING_TASKS, min(most, listing, key=int))
    try:
        return files.option("recursiveFileLookup", "true").load(path)
    finally:
        spark.conf.set(LISTING_TASKS, most)


def _index(files: DataFrame):
    """The listing of a file source."""
    return files._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()


def _tasks(files: DataFrame) -> int:
    """Tasks to read a file source in, small files many to a task."""
    index = _index(files)
    return max(index.allFiles().size() // TASK_FILES, index.sizeInBytes() // TASK_BYTES, TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism)


def _empty_files(files: DataFrame, path: str) -> list[str]:
    """Plain paths of the files of zero bytes that the source of ``files`` has listed at ``path`` and does not read."""
    spark = files.sparkSession
    index = _index(files)
    nil = getattr(getattr(spark._jvm.scala.collection.immutable, "Nil$"), "MODULE$")
    # Two numbers tell whether there are any: asking the JVM for each file would cost far more than listing them.
    if index.allFiles().size() == index.listFiles(nil, nil).head().files().size():
        return []
    every = spark.createDataFrame([(p,) for p in index.inputFiles()], "value string")
    read = _listed(spark.read.format("binaryFile"), path).select(F.col("_metadata.file_path").alias("value")).coalesce(_tasks(files))
    same = F.regexp_replace("value", "^file:/+", "file:/")
    empty = every.select(same.alias("path")).join(read.select(same.alias("path")), "path", "left_anti")
    return [r[0] for r in empty.select(_unescaped(F.col("path"))).collect()]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every file under a folder or glob as (document_path, extracted_text)."""
    files = _listed(spark.read.format("text").option("wholetext", "true"), path)
    plain = _unescaped(F.col("_metadata.file_path"))
    value = F.when(plain.rlike(OWN_FILE), F.regexp_replace("value", r"\n\z", "")).otherwise(F.col("value"))
    read = files.select(plain.alias("document_path"), unix_lines(value).alias("extracted_text")).coalesce(_tasks(files))
    empty = [(p, "") for p in _empty_files(files, path)]
    return read.unionByName(spark.createDataFrame(empty, "document_path string, extracted_text string")) if empty else read


def list_summaries(spark: SparkSession, folder: str, patient_id: str | None = None) -> DataFrame:
    """Text files of a folder, names descending; bodies are not read."""
    listed = _listed(spark.read.format("binaryFile").option("pathGlobFilter", "*.txt"), folder)
    files = listed.select(
        _file_name(F.col("path")).alias("file_name"),
        (F.col("length") - F.col("path").rlike(OWN_FILE).cast("int")).alias("size"),
        F.col("modificationTime").alias("modified_at"),
    ).coalesce(_tasks(listed))
    empty = [p for p in _empty_files(listed, folder) if p.endswith(".txt")]
    if empty:
        system = _file_system(spark, folder)
        place = spark._jvm.org.apache.hadoop.fs.Path
        times = [(p, datetime.fromtimestamp(system.getFileStatus(place(p)).getModificationTime() / 1000, timezone.utc)) for p in empty]
        rows = spark.createDataFrame(times, "path string, modified_at timestamp")
        files = files.unionByName(rows.select(base_name(F.col("path")).alias("file_name"), F.lit(0).cast("long").alias("size"), "modified_at"))
    if patient_id:
        files = files.filter(F.col("file_name").contains(patient_id))
    return files.orderBy(F.col("file_name").desc())


def get_summaries(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Content of each wanted file name; a missing file keeps its row as failed."""
    contents = files.select(
        _file_name(F.col("document_path")).alias("file_name"),
        F.col("extracted_text").alias("content"),
    )
    return wanted.select("file_name").join(contents, "file_name", "left").select(
        "file_name",
        F.when(F.col("content").isNull(), F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        "content",
    )


def _placed(rows: DataFrame, folder: str) -> None:
    """Write (file_name, value) rows below a mounted folder, laid out as by Spark's text writer.

    Each task writes to a folder of its own below a hidden one and a second job moves what the tasks
    that ended well have written, so a failed job leaves no new file and a repeated task no second one.
    """
    job = uuid.uuid4().hex
    staging = f"{folder}/.staging-{job}"

    def write(part: int, named: Iterator) -> Iterator[str]:
        import os

        own = f"{staging}/{part:05d}-{uuid.uuid4().hex}"
        last = None
        for name, value in named:
            at = f"{own}/file_name=" + (re.sub(ESCAPED, lambda c: f"%{ord(c[0]):02X}", name) if name else NO_NAME)
            if at != last:
                os.makedirs(at, exist_ok=True)
                last = at
            with open(f"{at}/part-{part:05d}-{job}.txt", "ab") as f:
                f.write(b"" if value is None else value)
                f.write(b"\n")
        if last:
            yield own

    def move(places: Iterator[str]) -> Iterator[int]:
        import os
        import shutil

        for own in places:
            for name in os.listdir(own):
                target = f"{folder}/{name}"
                try:
                    os.rename(f"{own}/{name}", target)
                    continue
                except OSError:  # the name is there already
                    os.makedirs(target, exist_ok=True)
                for old in (f"{target}/{x}" for x in os.listdir(target) if job not in x):
                    shutil.rmtree(old) if os.path.isdir(old) else os.unlink(old)
                for new in os.listdir(f"{own}/{name}"):
                    os.replace(f"{own}/{name}/{new}", f"{target}/{new}")
                os.rmdir(f"{own}/{name}")
        return iter(())

    context = rows.sparkSession.sparkContext
    try:
        places = rows.rdd.mapPartitionsWithIndex(write).collect()
        if places:
            context.parallelize(places, len(places)).mapPartitions(move).collect()
    finally:
        system = _file_system(rows.sparkSession, folder)
        system.delete(rows.sparkSession._jvm.org.apache.hadoop.fs.Path(f"file://{staging}"), True)


def write_text_files(rendered: DataFrame, folder: str, tasks: int | None = None) -> str:
    """Write (file_name, content) rows, each as its own text file; a name that is there
    already gets the new content.

    Creating files costs far more than moving their text, so rows are spread
    over at least as many tasks as there are cores. The line writer ends every
    file with a line end, which the readers above take off. File names must be unique.
    Spark's writer starts a process for each file and folder it makes in a mounted folder
    (``file:``), to set its mode, and moves them one by one on the driver; tasks of Python
    write there. Folders of other stores keep to Spark's writer.
    """
    spark = rendered.sparkSession
    tasks = tasks or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rendered.select("file_name", F.col("content").alias("value")).repartition(tasks, "file_name")
    place, system = spark._jvm.org.apache.hadoop.fs.Path(folder), _file_system(spark, folder)
    if system.getUri().getScheme() == "file":
        system.mkdirs(place)
        # As Spark's writer, which keeps rows of one name together in the order of their task.
        _placed(rows.withColumn("value", F.col("value").cast("binary")).sortWithinPartitions("file_name"), system.makeQualified(place).toUri().getPath())
    else:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_name").text(folder)
    return folder
