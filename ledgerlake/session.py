"""Session construction and the shared working folder.

Every layer the library writes (bronze, silver, gold, serving, stream
checkpoints) lives under one *lake root*.  On a cluster that root is the
shared folder named by ``spark.checkpoint.dir``; the library never invents a
machine-local folder there.  Only when the setting is absent (unit tests, a
laptop) does :func:`lake_root` create a private scratch folder and register it
as the checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on.  Time zone is pinned because every daily
# grain is ``to_date(event_time)`` (day boundaries must not move with the
# host).  AQE re-plans joins and shuffle sizes from runtime statistics and
# splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "ledgerlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings that may change on a running session (the state
    store too: streams started on a caller's session keep state in RocksDB)."""
    for k in ("spark.sql.session.timeZone",
              "spark.sql.streaming.stateStore.providerClass",
              "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.coalescePartitions.enabled",
              "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.parquet.filterPushdown"):
        if spark.conf.get(k, None) != DEFAULT_CONF[k]:
            spark.conf.set(k, DEFAULT_CONF[k])


def lake_root(spark: SparkSession) -> str:
    """The shared folder all layers and checkpoints go to.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  A
    session without one gets a private scratch folder in local mode, as in
    tests; on a cluster other machines could not read it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder all machines of {master} share")
        root = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder for one run of one job.

    Rebuilds write to a new versioned folder instead of deleting the old one
    in place (a crashed rebuild then never leaves a half-empty table).
    """
    return f"{lake_root(spark)}/runs/{name}-{uuid.uuid4().hex[:12]}"
