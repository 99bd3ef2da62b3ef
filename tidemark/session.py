"""Session settings the jobs are written for, and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages are large rows: small Arrow batches bound the memory of a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}
# Of versions and publications: texts take two thirds of the disk that Spark's default takes.
CODEC = "zstd"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def local_session(cores: str = "8", shuffle_partitions: str = "8", **extra) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def bounded_batches(spark: SparkSession, most: str = "4m") -> None:
    """Batches that Python workers get from now on in this session end at ``most`` bytes, if it sets no bound itself.

    By rows alone a batch of long texts is tens of megabytes, several times over: in Spark's
    buffers, in the worker's, and in what the worker makes of them.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, most)


@contextmanager
def small_files(spark: SparkSession, cost: str = "64k") -> Iterator[None]:
    """Plans that run within pack small files: Spark counts each as four megabytes, so a task would get thirty."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, cost)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    A cluster names a shared file system there. Only where the setting is absent (local
    runs and tests) is a temporary folder made, once per session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-tidemark-"))
        root = sc.getCheckpointDir()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``, in one listing; none if it does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(where) if entry.isDirectory())


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back.

    For results that several branches of a plan use: computed once, safe from lost
    executors, and of a size that Spark knows when it plans the joins on it.
    """
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    table = frame.sparkSession.read.schema(frame.schema).parquet(path)
    table._stored_at = path
    return table


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Removes tables written by ``stored`` once nothing that is still to run reads them."""
    for table in tables:
        remove_folder(table.sparkSession, table._stored_at)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of plans that have run and that nobody holds any more.

    Spark does so whenever the driver collects its garbage, which on a driver with little to do
    may be long after. Called between large steps that write their results.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
