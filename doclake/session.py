"""Session construction and the shared scratch location.

Operators never create sessions; they take DataFrames. This module is for
tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins from real shuffle sizes
# (broadcast only when the runtime size is under the threshold, otherwise a
# sort-merge join) and splits skewed partitions of a join side.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "doclake", extra: dict | None = None) -> SparkSession:
    """A session for local runs and tests (UI off, AQE on, UTC)."""
    builder = (SparkSession.builder
               .master(master or os.environ.get("DOCLAKE_MASTER", "local[8]"))
               .appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("DOCLAKE_DRIVER_MEMORY", "16g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator of the cluster (a shared file
    system); it is read from the session. Only when it is unset in a local
    run (tests) a fresh local folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext handle (Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="doclake-ckpt-")
        if sc is None:
            try:
                spark.conf.set("spark.checkpoint.dir", configured)
            except Exception:  # a core setting some sessions refuse at runtime
                pass
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go as soon as it is written.

    Otherwise they stay until the driver's JVM happens to collect its garbage,
    so a job of many steps holds the exchanges of all of them on disk. For
    steps whose result is read back from storage only."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
