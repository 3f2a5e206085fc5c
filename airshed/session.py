"""Spark session settings shared by jobs, checks, tests and the bench.

Cluster settings (executor sizes, master, checkpoint folder) belong to the
deployment; this module only pins what the results depend on (UTC session
zone, ANSI casts) and turns on the runtime re-planning the jobs rely on
(AQE coalescing, skew-join splitting, runtime broadcast conversion).
"""

from __future__ import annotations

import atexit
import logging
import os
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# Settings every job needs regardless of cluster size.
CORE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partition is skewed when it is 4x the median and above 128 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # No broadcast from file-size estimates (compressed parquet size says
    # little about the in-memory size): unhinted joins are planned as
    # shuffle joins, and AQE turns a side into a broadcast only after its
    # shuffle output was measured below the adaptive threshold. Fixed
    # tables (seeds, rule tables) carry explicit broadcast hints.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "airshed",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the core settings applied.

    ``master`` and ``shuffle_partitions`` are only set when given, so a
    cluster submit keeps its own values.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in CORE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_core_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable core settings to an existing session."""
    for key, value in CORE_CONF.items():
        if key == "spark.ui.enabled":
            continue
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset
    and the master is local (tests, development) a folder is chosen and
    registered. On a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        master = sc.master or ""
        if not master.startswith("local"):
            # a machine-local folder is not shared by the executors
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's object store)")
        configured = os.path.join(tempfile.gettempdir(), "airshed-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables.
    The folder of an application is removed when its driver ends, or by
    ``clear_scratch``."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/airshed/{spark.sparkContext.applicationId}"
    if base not in _scratch:
        _scratch.add(base)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        atexit.register(_remove_folder, jvm, conf, base)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_scratch: set[str] = set()


def _remove_folder(jvm, conf, path: str) -> None:
    where = jvm.org.apache.hadoop.fs.Path(path)
    try:
        where.getFileSystem(conf).delete(where, True)
    except (Py4JError, OSError):  # the JVM went first: the folder stays
        logging.getLogger("airshed.session").warning("scratch folder %s was not removed", path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application has written to its scratch folder;
    DataFrames that still read from there fail afterwards."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/airshed/{spark.sparkContext.applicationId}"
    _remove_folder(spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), base)


def input_bytes(spark: SparkSession, paths: list[str] | str) -> int:
    """Total size of the files under ``paths`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def sized_session(spark: SparkSession, paths: list[str] | str,
                  target_bytes: int = 128 * 1024 * 1024) -> SparkSession:
    """A session of the same application whose shuffles start with about one
    partition per ``target_bytes`` of the input under ``paths``, never fewer
    than the cluster's cores. AQE coalesces partitions that turn out small
    but splits large ones only in joins, so the initial count follows the
    data. The caller's session keeps its settings."""
    parts = str(max(-(-input_bytes(spark, paths) // target_bytes), spark.sparkContext.defaultParallelism, 1))
    sized = spark.newSession()
    apply_core_conf(sized)
    sized.conf.set("spark.sql.shuffle.partitions", parts)
    sized.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", parts)
    return sized
