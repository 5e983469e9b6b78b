"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str = "riverwatch",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    rocksdb_state: bool = False,
) -> SparkSession:
    """Session with the settings every job here relies on.

    UTC session time (hour-of-day must not depend on the host), AQE on
    (coalesces the small aggregate shuffles, splits skewed partitions),
    UI off. On a cluster leave ``master`` and ``shuffle_partitions`` unset
    so the cluster's values win. For the speed layer, the shuffle partition
    count in force at a query's first start becomes its number of state
    partitions for good, so size it then. ``rocksdb_state`` keeps streaming
    state in RocksDB off the JVM heap with changelog checkpoints, for large
    state (many locations x windows, complete mode).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # drop the batch summary's checkpoint files once nothing refers to them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
        conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # getOrCreate may return a running session: the time zone must still hold.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS/S3/ABFS path) and is used as is;
    unset, it is an error there. Only a local-mode session (tests) gets a
    folder under the local temp dir when it is unset.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set: point it at a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="riverwatch-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder (fresh by default)."""
    root = checkpoint_root(spark).rstrip("/")
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([root, "riverwatch", *leaf])


def local_dir(path: str) -> str:
    """Strip a ``file:`` scheme, for the few callers that touch the local FS."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return os.fspath(path)
