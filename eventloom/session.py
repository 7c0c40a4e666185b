"""SparkSession construction for scripts, tests and the benchmark.

Library functions never build a session; they take DataFrames.  This
helper only sets defaults that matter for the pipeline (AQE, skew join,
UTC session time zone) and never overrides a value the cluster already
provides, in particular ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Applied where the cluster's configuration sets nothing.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}

#: Spark's switch for dropping the shuffle files of a query when it ends.
SHUFFLES_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, app: str = "eventloom",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; ``extra`` is the caller's own choice and always applies."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    given = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared filesystem folder
    and is used as is.  Only in local mode, where driver and tasks share one
    machine, a scratch folder is made when nothing is configured; elsewhere
    that would scatter files over the executors' disks, so it is an error.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur.rstrip("/")
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if base is None:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.environ.get("EVENTLOOM_SCRATCH") or tempfile.mkdtemp(prefix="eventloom-ckpt-")
    sc.setCheckpointDir(base)
    return (sc.getCheckpointDir() or base).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run within it drop their shuffle files when they end; else these lie on the executors' disks until a
    garbage collection of the driver finds the query unused, which a driver with memory to spare puts off."""
    before = spark.conf.get(SHUFFLES_DROPPED)
    spark.conf.set(SHUFFLES_DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_DROPPED, before)
