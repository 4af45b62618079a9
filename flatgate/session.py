"""Session profiles and the shared scratch folder.

Two profiles mirror the deployment split of the original job: ``cluster``
(resource manager decides the master) and ``local`` (tests, ``local[*]``).
Both share the write-side settings: snappy parquet, dynamic partition
overwrite, no summary metadata, predicate pushdown on.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings shared by every profile (fixed values of the deployed job).
COMMON_CONF = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.hadoop.parquet.enable.summary-metadata": "false",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.hive.metastorePartitionPruning": "true",
    "spark.sql.broadcastTimeout": "1800",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Cluster sizing (100 TB class inputs on ~1000 executors). Shuffles start
# wide and AQE coalesces them to ~256 MB partitions at run time, so a rule
# run over a small table does not pay for the width; skewed partitions of
# joins are split. Scan splits of 256 MB keep task counts manageable.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "8m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # broadcast only what the planner measured small
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # task retries survive lost executors; speculation trims stragglers
    "spark.task.maxFailures": "8",
    "spark.speculation": "true",
}

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
}


def get_session(profile: str = "local", app_name: str = "flatgate", **extra) -> SparkSession:
    """Build (or reuse) a session for ``profile`` in {'local', 'cluster'}."""
    builder = SparkSession.builder.appName(app_name)
    if profile == "local":
        builder = builder.master(os.environ.get("FLATGATE_MASTER", "local[*]"))
        conf = {**COMMON_CONF, **LOCAL_CONF}
    elif profile == "cluster":
        conf = {**COMMON_CONF, **CLUSTER_CONF}
    else:
        raise ValueError(f"unknown profile {profile!r}")
    conf.update({k: str(v) for k, v in extra.items()})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is; without it a cluster session is refused. Only a local master
    (tests, a laptop) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="flatgate-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def application_id(spark: SparkSession) -> str:
    """The running application's id (also without a local SparkContext)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", "unknown")


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint root.

    Used for round-trip writes and stream checkpoints, so everything a job
    writes lands in storage every executor can see. What is left of it when
    the driver process ends is deleted.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    # inside the application's own checkpoint folder, which goes with it
    folder = f"{root}/flatgate"
    if folder not in _scratch_roots:
        _scratch_roots.add(folder)
        atexit.register(_remove_at_exit, spark.sparkContext, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


_scratch_roots: set[str] = set()


def _remove_at_exit(sc, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        _remove(sc, folder)


def _remove(sc, path: str) -> None:
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def remove_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders that nothing reads any more."""
    for path in paths:
        _remove(spark.sparkContext, path)
