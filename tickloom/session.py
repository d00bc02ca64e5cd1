"""Session settings the library depends on, and where it may write scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set only where the cluster's own configuration is silent.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Start wide and let AQE merge small shuffle partitions.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Window state keyed by symbol can outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "tickloom", master: str | None = None,
                  overrides: dict[str, str] | None = None) -> SparkSession:
    """A session with UTC time and settings for large shuffles. Settings of the cluster, and those
    already made in a running session, win over ours."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (overrides or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    cluster, untouched = spark.sparkContext.getConf(), spark.newSession()
    for key, value in CLUSTER_DEFAULTS.items():
        changed = spark.conf.get(key, None) != untouched.conf.get(key, None)
        if not (key in (overrides or {}) or cluster.contains(key) or changed):
            spark.conf.set(key, value)
    return pin_utc(spark)


def pin_utc(spark: SparkSession) -> SparkSession:
    """Ticks carry wall-clock time without a zone; every date and window is taken in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint directory of the cluster, deleted when the session's
    process ends.

    A machine-local folder is used only in local mode, where one machine runs everything.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="tickloom-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back.

    For a result with several consumers: the input is scanned once, the lineage ends at files that
    outlive lost executors, and readers still get column pruning.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
