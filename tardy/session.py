"""Session helpers: a local session for tests / bench, and the shared scratch root.

Jobs never pick a machine-local temp folder on their own. Every intermediate
table, checkpoint and stream state lives under the folder the cluster names in
``spark.checkpoint.dir``; only when that is unset (local tests) do we create one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

# Settings for local[N] runs (tests, bench). On a cluster these come from spark-submit.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    "spark.sql.shuffle.partitions": "8",
    # A whole-stage method above HotSpot's 8000-byte JIT limit runs interpreted
    # (10x slower); make Spark split such stages instead of generating one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # percentile_approx runs in ObjectHashAggregate, which switches to sorting
    # after 128 groups per task; gold sees thousands of (day, airline, origin)
    # groups per task, and each sketch buffer is small.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit only the changed state each micro-batch instead of a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Tasks merge a key's sessions before the shuffle: a hot key ships sessions, not rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def local_session(cpus: int | str = "*", app: str = "tardy", **conf: str) -> SparkSession:
    """Build (or reuse) a local session with the defaults above, plus overrides."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


# The settings that the batch and stream jobs' plans were made for, wherever they run.
PLAN_SETTINGS = ("spark.sql.codegen.", "spark.sql.objectHashAggregate.")


@contextmanager
def plan_settings(spark: SparkSession) -> Iterator[None]:
    """``PLAN_SETTINGS`` for a while, each where the session sets none itself: with Spark's defaults the stages
    that read and flag the flights are one method each above HotSpot's limit, and run interpreted."""
    set_already = spark.conf.getAll
    missing = {k: v for k, v in LOCAL_CONF.items() if k.startswith(PLAN_SETTINGS) and k not in set_already}
    for key, value in missing.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in missing:
            spark.conf.unset(key)


def with_plan_settings(job: Callable) -> Callable:
    """A job whose first argument is the session, run under ``plan_settings``."""
    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with plan_settings(spark):
            return job(spark, *args, **kwargs)
    return run


# Spark's default writer of stream checkpoints starts processes on a local file system: a readlink and chmod for each file.
CHECKPOINT_WRITER = "spark.sql.streaming.checkpointFileManagerClass"
LOCAL_CHECKPOINT_WRITER = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


@contextmanager
def checkpoint_writer(spark: SparkSession, checkpoint: str) -> Iterator[None]:
    """For a while, checkpoints on a local file system are written by its own renames (atomic there, too). Others are
    left to Spark's choice, and the session's choice stands."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint)
    scheme = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme != "file" or CHECKPOINT_WRITER in spark.conf.getAll:
        yield
        return
    spark.conf.set(CHECKPOINT_WRITER, LOCAL_CHECKPOINT_WRITER)
    try:
        yield
    finally:
        spark.conf.unset(CHECKPOINT_WRITER)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and checkpoints.

    Read from the session (``spark.checkpoint.dir`` or an already set checkpoint
    dir). Only if neither is set and the master is local, as in tests, a fresh folder
    is created; on a cluster a machine-local folder would lose rows, so this raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    master = sc.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"master {master}: set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tardy-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the scratch root (not created)."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, partition_by: list[str] = []) -> DataFrame:
    """Cut lineage with one pass: write ``df`` as Parquet under the shared
    scratch root (``partition_by``: a folder per value of these) and read it back. Survives executor loss (the files live on
    the shared file system) and, unlike a reliable ``checkpoint()``, computes
    the input only once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if partition_by else spark.read.parquet(path)


# Shuffle files go when the statement that wrote them has ended, not when the driver's garbage is collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """For a while, each statement removes its shuffle files at its end, where the session doesn't say itself."""
    if SHUFFLE_CLEANUP in spark.conf.getAll:
        yield
        return
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as a table under the scratch root, which is removed at the end."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
