"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every job relies on: UTC clock, ANSI arithmetic, AQE.
SESSION_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Wide projections (70+ columns) compile to one method above 8 kB, which
    # the JVM does not JIT.  Such stages take Spark's split projections instead,
    # also where the session was built elsewhere and lacks the JVM option below.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that writes into few partitions keeps a file open for each, and
    # sorts wide rows by partition only beyond this number.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Jobs here are chains of written tables: what a step shuffled goes when the step
    # has ended, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Batches of 70 columns that stay in the processor's cache (4,096 rows do not).
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
    # Python call-site capture for error messages costs several gateway
    # round trips per Column built; plans here are built from hundreds of
    # Columns, so it is off (a static setting: only for sessions built here).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Wide projections (70+ columns) compile to one large method per stage;
    # the JVM does not JIT methods above 8 kB by default and would run them
    # interpreted (about 3x slower here).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pitchlake", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster the master and the checkpoint folder come from the
    submitter; in local mode a checkpoint folder is created when none is set.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = SparkConf()  # what the submitter set; its JVM options are kept
    for k, v in SESSION_CONF.items():
        if k.endswith("extraJavaOptions") and submitted.get(k, None):
            v = f"{submitted.get(k)} {v}"
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    ``spark.checkpoint.dir`` is read from the session.  Only a local-mode
    session without one (tests) gets a private folder; a cluster session
    without one is an error, because a machine-local folder would not be
    visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="pitchlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, for written tables.

    The parent is ``spark.checkpoint.dir`` (visible to every executor), each
    call gets its own sub-folder so runs never clear each other's files.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    root = os.path.dirname(base) if "/" in base else base
    return f"{root}/pitchlake-scratch/{name}-{uuid.uuid4().hex[:12]}"
