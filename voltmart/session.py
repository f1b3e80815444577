"""Session settings the warehouse relies on, and where it may write."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings only: memory, cores and shuffle width stay the cluster's choice.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that were brought together by one of a join's keys may stay so (see keys.upsert).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Shuffle files go when their query ends, not when the driver's memory happens to be collected.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Batches sent to Python by size, so that long texts do not fill a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a join side whose shuffled parts are all small is hashed and the other one need not be sorted."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "64m")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach. Only a local session may fall back to /tmp."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="voltmart-")
    return _LOCAL_ROOTS[context.applicationId]


_STEP: ContextVar[str | None] = ContextVar("step", default=None)  # the folder of the step under way


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared root, or below the folder of the step under way; none is reused."""
    return f"{_STEP.get() or shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[None]:
    """A step that leaves nothing lazy behind: the scratch tables it writes go when it ends. Jobs that run
    `together` in it belong to it."""
    folder = work_dir(spark, label)
    outer = _STEP.set(folder)
    try:
        yield
    finally:
        _STEP.reset(outer)
        remove(spark, folder)


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write to the shared folder and read back, so that a lost executor cannot lose the rows.

    Used where a result feeds several branches or a loop. A written table is computed once and keeps
    its size statistics, which an RDD checkpoint does not.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run independent jobs side by side and return their results in order. Each is a Spark job or a few;
    the scheduler fills with one what the tail of another leaves idle. The first failure is raised once
    all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(copy_context().run, inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in started]
