"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the semantics depend on. They are applied to a session we build
# ourselves; on a cluster the operator applies them in its own config.
REQUIRED_CONF = {
    # Every timestamp literal and date boundary is read in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Overflows and bad casts raise instead of silently producing NULL.
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Re-running a load replaces only the partitions it touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Suggested cluster settings for ~100 TB of readings (applied by the cluster
# operator, never forced by the library):
# - 512 MB scan splits: 100 TB / 512 MB ~ 200k scan tasks instead of ~800k at
#   the 128 MB default, i.e. ~25 waves on 1000 executors x 8 cores.
# - Shuffle partitions sized for the largest shuffle, the upsert of one load
#   (marts only shuffle partial aggregates); AQE coalesces the rest toward
#   the 256 MB advisory size and splits skewed partitions.
CLUSTER_HINTS = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, app: str = "stratus",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master``/``shuffle_partitions``/``driver_memory`` are for local runs and
    tests (in local mode all tasks run in the driver JVM, whose default heap
    is 1 GB); on a cluster leave them unset so the cluster's values apply.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


# Settings whose values change results (not just speed).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def ensure_semantics(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (UTC session time, ANSI) on any session."""
    for k, v in SEMANTIC_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there; we only pick our own
    when it is unset on a local master (tests), and raise otherwise.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="stratus-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, purpose: str, create: bool = False) -> str:
    """A fresh, unique folder for tables a job writes, under the shared checkpoint dir.

    Spark writers create the folder themselves; ``create=True`` makes it up
    front (local paths only) for callers that place files there directly.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/stratus/{purpose}-{uuid.uuid4().hex[:12]}"
    if create and ("://" not in path or path.startswith("file:")):
        os.makedirs(path.removeprefix("file:"), exist_ok=True)
    return path
