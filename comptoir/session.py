"""Session helpers: builder for local runs and runtime settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Runtime-settable options that the operators rely on for deterministic,
# scale-aware plans. They are applied to any session handed to us.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Parquet columns unpack to many times their size: a task reads a bounded number of rows however large the files are
    "spark.sql.files.maxPartitionBytes": "16m",
    # rows go to Python workers in batches of bounded bytes, however long a row is
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings (UTC clock, AQE with skew handling)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build(master: str | None = None, cores: int | None = None, app: str = "comptoir",
          shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local/test builder. On a cluster the session comes from the platform and
    only :func:`prepare` is applied."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "0") or 0) or os.cpu_count() or 4
    master = master or f"local[{cores}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
         .config("spark.driver.memory", os.environ.get("COMPTOIR_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


SHARED_DIR_KEY = "comptoir.sharedDir"


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (what the cluster names; a static setting).
    Only when it is unset in a local session (else it is an error) a scratch folder is
    created once per session and remembered under a runtime key of our own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED_DIR_KEY, None)
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is unset and the master is {master}: name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="comptoir-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(SHARED_DIR_KEY, d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def new_subdir(spark: SparkSession, name: str) -> str:
    """A unique path below the shared folder (not created; writers create it)."""
    import uuid
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
