"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime-settable; each helps skewed or badly sized shuffles.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # operators.joins.lookup needs joins to shuffle by all of their keys.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.session.timeZone": "UTC",
    # Sessions of a busy key are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Stream state on executor disks instead of their heaps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Batches save what changed in the state, not all of it.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Streams with several states and timers per key run on this store alone; those started before keep their own."""
    for key in RUNTIME_CONF:
        if ".stateStore." in key:
            spark.conf.set(key, RUNTIME_CONF[key])


def local_session(app: str = "vellumflow", cores: str | int = 8, memory: str = "8g", work: str | None = None) -> SparkSession:
    """A single-JVM session for tests and the bench, with a work folder of its own unless
    one is given; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", work or tempfile.mkdtemp(prefix="vellumflow-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="vellumflow-")


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only in local mode, where the driver is the executor, may it be unset: the session
    then gets a folder of its own. On a cluster that is an error, since executors do
    not see a folder of the driver's.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the working folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
