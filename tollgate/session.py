"""SparkSession construction and the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators depend on for their meaning (not only speed).
REQUIRED_CONF = {
    # Access-log times are compared across engines and days: pin the zone.
    "spark.sql.session.timeZone": "UTC",
    # Cookie / query-string maps: a repeated key keeps its last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# State of streaming queries: on the executors' disks, with one bounded share of native memory per executor.
# The engine's default keeps every open row on the heap, twice; a backfill opens the panes of all its rows at once.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # half of it for filters and indices: a lookup that must read them anew takes a millisecond
    "spark.sql.streaming.stateStore.rocksdb.writeBufferCacheRatio": "0.3",
    "spark.sql.streaming.stateStore.rocksdb.highPriorityPoolRatio": "0.5",
}
# Counting all state rows looks up every key that is put or removed.
COUNT_STATE = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"

# Settings for scale: adaptive re-planning, skew splitting, partition coalescing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def cluster_conf(shuffle_bytes: float, target_partition_bytes: float = 256 * 2**20) -> dict:
    """Settings for a large cluster, sized from the expected largest shuffle.

    Initial shuffle partitions ~ shuffle bytes / target (AQE coalesces the small
    ones at runtime and splits skewed ones); input splits of 256 MB; broadcast
    only for sides measured under 64 MB; a partition is skewed at 5x the median.
    """
    parts = max(200, int(shuffle_bytes / target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_partition_bytes)),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        **STATE_CONF,
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tollgate", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the required settings applied."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        b = b.config("spark.driver.memory", os.environ.get("TOLLGATE_DRIVER_MEMORY", "16g"))
    for k, v in {**SCALE_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session (e.g. the driver's), and those of streaming state that it has not set."""
    own = spark.conf.getAll
    for k, v in {**REQUIRED_CONF, **{k: v for k, v in STATE_CONF.items() if k not in own}}.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session (tests) without the setting gets a folder of our own;
    on a cluster a machine-local folder would not survive a lost executor, so
    the setting is required there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):     # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
        d = tempfile.mkdtemp(prefix="tollgate-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name)
